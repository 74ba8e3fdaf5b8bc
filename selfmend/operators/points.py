"""A bagged forest learnt from its points (M1/M2) when there are many rows.

MLlib's learner bags and meets every row in every tree and level: a hundred
trees cost a hundred visits a row and level. It sees a numeric feature only by
its bin, though (32 at most), so rows that are alike in every bin and in the
label are one *point*, and what a tree learns from is how often it drew each.
A row is drawn Poisson(1) times; the ``n`` rows of a point together Poisson(n)
times, the sum of ``n`` independent draws. Every row thus counts, and a tree
costs its points instead of its rows.

Else the trees are grown as MLlib grows them: by level, a fresh subset of the
features at every node, gini, children that agree merged. A task grows a tree
from the points, whose number is bounded by the caller. The forest is written
in MLlib's format and loaded: a ``RandomForestClassificationModel`` like any.

Bins of a feature with up to ``maxBins`` values are its values, cut half-way;
of one with more, its exact quantiles, from a range-partitioned sort.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from selfmend.operators.features import FEATURES, LABEL
from selfmend.session import scratch_path

# tasks get the functions of this module with their code: they need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Values of numeric features that are sorted in a partition, about.
PART_VALUES = 1_000_000

NODES = """treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>,
rawCount: bigint, gain: double, leftChild: int, rightChild: int,
split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"""
NODES_ARROW = pa.schema([("treeID", pa.int32()), ("nodeData", pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
    ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                         ("numCategories", pa.int32())]))]))])


# ------------------------------------------------------------------- bins ---
def numeric_slots(encoded: DataFrame, n_features: int) -> list[int]:
    """The slots of the feature vector that are not one-hot (two values)."""
    attrs = encoded.schema[FEATURES].metadata.get("ml_attr", {}).get("attrs", {})
    one_hot = {a["idx"] for a in attrs.get("binary", [])}
    return [i for i in range(n_features) if i not in one_hot]


def thresholds(encoded: DataFrame, weight: str, slots: Sequence[int], max_bins: int) -> dict[int, list[float]]:
    """For each of ``slots`` the rising thresholds of its bins, ``max_bins - 1``
    at most; a value up to a threshold lies below it."""
    if not slots:
        return {}
    v = F.col("_v")
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("slot"), v[i].alias("value")) for i in slots]))
    path = scratch_path(encoded.sparkSession, "feature-values")
    (encoded.select(vector_to_array(F.col(FEATURES)).alias("_v"), F.col(weight).cast("long").alias("_n")).select(cells.alias("s"), "_n")
     .groupBy("s.slot", "s.value").agg(F.sum("_n").alias("n")).write.parquet(path))
    counts = encoded.sparkSession.read.parquet(path)
    sizes = {r["slot"]: r["k"] for r in counts.groupBy("slot").agg(F.count(F.lit(1)).alias("k")).collect()}
    few, many = ([i for i in slots if (sizes.get(i, 0) > max_bins) == large] for large in (False, True))
    values: dict[int, list[float]] = {i: [] for i in slots}
    if few:
        for r in counts.where(F.col("slot").isin(few)).collect():
            values[r["slot"]].append(r["value"])
    out = {i: [_between(a, b) for a, b in zip(x, x[1:])] for i, x in ((i, sorted(x)) for i, x in values.items())}
    if many:
        for r in quantile_values(counts.where(F.col("slot").isin(many)), max_bins, sum(sizes[i] for i in many)).collect():
            out[r["slot"]] += [r["value"]] * r["ends"] + [math.nextafter(r["value"], -math.inf)] * r["heavy"]
    return {i: sorted(set(x)) for i, x in out.items()}


def _between(a: float, b: float) -> float:
    m = a + (b - a) / 2
    return m if a <= m < b else a


def quantile_values(counts: DataFrame, parts: int, n_values: int) -> DataFrame:
    """(slot, value, ends, heavy): of ``counts`` (slot, value, n) the values at
    which a bin ends, as a ``parts``-th part of the slot's rows ends in them
    (not the last), and the heavy ones, which hold a whole part and are a bin
    of their own: the one before ends below them. Values are ranked in a
    range-partitioned sort, so that no slot's values pass one task."""
    spark, path = counts.sparkSession, scratch_path(counts.sparkSession, "sorted-values")
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_values // PART_VALUES))
    (counts.repartitionByRange(partitions, "slot", "value").withColumn("_part", F.spark_partition_id())
     .write.parquet(path))                           # partitions are those of this one sort
    ranked = spark.read.parquet(path)
    before = Window.partitionBy("slot").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranked.groupBy("slot", "_part").agg(F.sum("n").alias("_rows"))
              .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
              .withColumn("_all", F.sum("_rows").over(Window.partitionBy("slot"))))     # a row per slot and partition
    within = Window.partitionBy("slot", "_part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    upto = ranked.withColumn("_in", F.sum("n").over(within)).join(starts.hint("merge"), ["slot", "_part"]) \
        .withColumn("_upto", F.col("_in") + F.col("_before"))
    ended = [F.floor(c * parts / F.col("_all")) for c in (F.col("_upto"), F.col("_upto") - F.col("n"))]
    k, ends = ended[0] - ended[1], F.col("_upto") < F.col("_all")
    return upto.where((k > 1) | ((k > 0) & ends)).select("slot", "value", ends.alias("ends"), (k > 1).alias("heavy"))


def points(encoded: DataFrame, weight: str, cuts: dict[int, list[float]], n_features: int) -> DataFrame:
    """(bins, label, n): rows alike in every bin and the label, counted. The
    bin of a feature is the number of its thresholds below the value; of a
    one-hot slot, whether it is set."""
    v, cut = F.col("_v"), [i for i in range(n_features) if cuts.get(i)]
    rows = (encoded.select(vector_to_array(F.col(FEATURES)).alias("_v"), LABEL, F.col(weight).cast("long").alias("_n"))
            .select(LABEL, "_n", *[(v[i] if i in cuts else (v[i] != 0).cast("int")).alias(f"_f{i}") for i in range(n_features)]))
    if cut:         # its buckets hold their lower end, bins their upper one
        ends = [[-math.inf, *[math.nextafter(t, math.inf) for t in cuts[i]], math.inf] for i in cut]
        rows = Bucketizer(splitsArray=ends, inputCols=[f"_f{i}" for i in cut], outputCols=[f"_b{i}" for i in cut]).transform(rows)
    bins = [F.col(f"_b{i}").cast("int") if i in cut else F.lit(0) if i in cuts else F.col(f"_f{i}") for i in range(n_features)]
    return rows.groupBy(F.array(*bins).alias("bins"), LABEL).agg(F.sum("_n").alias("n"))


# ------------------------------------------------------------------ trees ---
def gini(stats: np.ndarray) -> np.ndarray:
    """Gini impurity over the last axis (class counts); 0 where there is nothing."""
    n = stats.sum(axis=-1, keepdims=True)
    return np.where(n[..., 0] > 0, 1 - (np.divide(stats, n, out=np.zeros_like(stats), where=n > 0) ** 2).sum(axis=-1), 0.0)


def grow(bins: np.ndarray, labels: np.ndarray, weights: np.ndarray, n_bins: Sequence[int], n_classes: int,
         max_depth: int, per_node: int, rng: np.random.Generator) -> list[dict]:
    """One tree over points (``bins``: features by points) of which each occurs
    ``weights`` times, as its nodes: class counts ``stats`` and, if split,
    ``feature``, ``cut`` (the last bin on the left), ``gain``, ``left``, ``right``."""
    met = np.flatnonzero(weights > 0)
    bins, labels, weights = bins[:, met], labels[met].astype(np.int64), weights[met].astype(float)
    nodes = [{"stats": np.bincount(labels, weights, n_classes)}]
    live, at = [0], np.zeros(len(met), dtype=np.int64)        # nodes of the level; each point's place among them
    for level in range(max_depth):
        if not live:
            break
        m, total = len(live), np.stack([nodes[i]["stats"] for i in live])
        whole, weight = gini(total), total.sum(axis=1)
        chosen = np.zeros((m, len(bins)), dtype=bool)
        np.put_along_axis(chosen, rng.random((m, len(bins))).argsort(axis=1)[:, :per_node], True, axis=1)
        gain, feature, cut = np.zeros(m), np.full(m, -1), np.zeros(m, dtype=np.int64)
        lefts = np.zeros((m, n_classes))
        for f in range(len(bins)):
            if n_bins[f] < 2 or not chosen[:, f].any():
                continue
            here = np.flatnonzero(chosen[at, f])
            key = (at[here] * n_bins[f] + bins[f, here]) * n_classes + labels[here]
            left = np.bincount(key, weights[here], m * n_bins[f] * n_classes).reshape(m, n_bins[f], n_classes).cumsum(axis=1)[:, :-1]
            right = total[:, None] - left
            n_left, n_right = left.sum(axis=2), right.sum(axis=2)
            by_cut = whole[:, None] - (n_left * gini(left) + n_right * gini(right)) / weight[:, None]
            by_cut[(n_left < 1) | (n_right < 1)] = -1.0
            best = by_cut.argmax(axis=1)
            of_best = by_cut[np.arange(m), best]
            better = chosen[:, f] & (of_best > gain)
            gain[better], feature[better], cut[better] = of_best[better], f, best[better]
            lefts[better] = left[np.arange(m), best][better]
        children, places = [], np.full((m, 2), -1)
        for k in np.flatnonzero(feature >= 0):
            node = nodes[live[k]]
            node.update(feature=int(feature[k]), cut=int(cut[k]), gain=float(gain[k]), left=len(nodes), right=len(nodes) + 1)
            for side, stats in enumerate((lefts[k], total[k] - lefts[k])):
                nodes.append({"stats": stats})
                if level + 1 < max_depth and gini(stats) > np.finfo(float).eps:
                    places[k, side] = len(children)
                    children.append(len(nodes) - 1)
        side = (bins[feature[at], np.arange(len(at))] > cut[at]).astype(np.int64)
        to = np.where(feature[at] >= 0, places[at, side], -1)
        on = to >= 0
        bins, labels, weights, at, live = bins[:, on], labels[on], weights[on], to[on], children
    return nodes


def saved(nodes: list[dict], cuts: dict[int, list[float]]) -> list[dict]:
    """The nodes as MLlib saves them: in preorder, with children that predict
    the same class merged into their parent."""
    def prediction(i):
        return int(np.argmax(nodes[i]["stats"]))

    leaf = {}
    for i in reversed(range(len(nodes))):       # children come after their parent
        x = nodes[i]
        leaf[i] = "left" not in x or (leaf[x["left"]] and leaf[x["right"]] and prediction(x["left"]) == prediction(x["right"]))
    out: list[dict] = []

    def visit(i):
        x, me = nodes[i], {"id": len(out)}
        out.append(me)
        me |= {"prediction": float(prediction(i)), "impurity": float(gini(x["stats"])), "impurityStats": x["stats"].tolist(),
               "rawCount": int(x["stats"].sum()), "gain": -1.0, "leftChild": -1, "rightChild": -1,
               "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
        if not leaf[i]:
            f = x["feature"]
            where = ([cuts[f][x["cut"]]], -1) if f in cuts else ([0.0], 2)
            me |= {"gain": x["gain"], "split": dict(zip(me["split"], (f, *where))),
                   "leftChild": visit(x["left"]), "rightChild": visit(x["right"])}
        return me["id"]

    visit(0)
    return out


# ----------------------------------------------------------------- forest ---
def features_per_node(strategy: str, n_features: int, n_trees: int) -> int:
    """How many features MLlib tries at a node."""
    if strategy == "auto":
        strategy = "all" if n_trees == 1 else "sqrt"
    known = {"all": n_features, "onethird": n_features / 3, "sqrt": math.sqrt(n_features),
             "log2": max(1, math.log(n_features, 2))}
    n = known[strategy] if strategy in known else int(strategy) if strategy.isdigit() else float(strategy) * n_features
    return min(n_features, math.ceil(n))


def learn(learner: RandomForestClassifier, counted: DataFrame, cuts: dict[int, list[float]], n_features: int,
          n_classes: int) -> RandomForestClassificationModel:
    """The ``learner``'s forest over ``points``: a task grows a tree. What a
    tree draws depends on the seed, its number and the points alone."""
    spark = counted.sparkSession
    table = counted.select(F.col("bins").cast("array<tinyint>").alias("bins"), F.col(LABEL).cast("int").alias("label"), "n").toArrow().combine_chunks()
    bins = table["bins"].combine_chunks().flatten().to_numpy().reshape(-1, n_features).T
    labels, n = table["label"].to_numpy(), table["n"].to_numpy()
    order = np.lexsort([labels, *bins])
    bins, labels, n = np.ascontiguousarray(bins[:, order]), labels[order], n[order]
    n_bins = [len(cuts[i]) + 1 if i in cuts else 2 for i in range(n_features)]
    seed, depth, n_trees = learner.getSeed(), learner.getMaxDepth(), learner.getNumTrees()
    per_node = features_per_node(learner.getFeatureSubsetStrategy(), n_features, n_trees)

    def trees(batches):
        for batch in batches:
            for tree in batch["id"].to_pylist():
                rng = np.random.Generator(np.random.Philox(np.random.SeedSequence([seed % 2 ** 64, tree])))
                nodes = saved(grow(bins, labels, rng.poisson(n), n_bins, n_classes, depth, per_node, rng), cuts)
                yield pa.RecordBatch.from_pylist([{"treeID": tree, "nodeData": x} for x in nodes], schema=NODES_ARROW)

    grown = spark.range(0, n_trees, 1, n_trees).mapInArrow(trees, NODES)
    return _loaded(spark, learner, grown, n_features, n_classes)


def _loaded(spark: SparkSession, learner: RandomForestClassifier, nodes: DataFrame, n_features: int,
            n_classes: int) -> RandomForestClassificationModel:
    """The model whose trees are ``nodes``, by way of MLlib's saved form."""
    path = scratch_path(spark, "forest")
    nodes.write.parquet(f"{path}/data")
    learner.write().save(f"{path}/learner")
    own = json.loads(spark.read.text(f"{path}/learner/metadata").first()["value"])
    name = "org.apache.spark.ml.classification.{}ClassificationModel"
    sizes = {"numFeatures": n_features, "numClasses": n_classes}
    kept = ("cacheNodeIds", "featuresCol", "impurity", "labelCol", "maxBins", "maxDepth", "seed")
    defaults = {k: v for k, v in own["defaultParamMap"].items()
                if k not in ("bootstrap", "featureSubsetStrategy", "numTrees", "subsamplingRate")}
    n_trees = learner.getNumTrees()
    trees = [own | sizes | {"class": name.format("DecisionTree"), "uid": f"{own['uid']}_{i}", "defaultParamMap": defaults,
                            "paramMap": {k: own["paramMap"][k] for k in kept if k in own["paramMap"]}} for i in range(n_trees)]
    spark.createDataFrame([(i, json.dumps(t), 1.0) for i, t in enumerate(trees)], "_1 int, _2 string, _3 double") \
        .coalesce(1).write.parquet(f"{path}/treesMetadata")
    whole = own | sizes | {"class": name.format("RandomForest"), "numTrees": n_trees}
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return RandomForestClassificationModel.load(path)

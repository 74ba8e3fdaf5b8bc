"""Train / score flow, model behaviour, attaching and sinks."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import ticket_fixture as TF
from conftest import write_lines
from selfmend.functions.rules import OneOf, Range, RuleSet
from selfmend.operators import attach, features, sinks
from selfmend.plans import scoring
from selfmend.plans import tickets as T
from selfmend.sources import delimited as src


@pytest.fixture(scope="module")
def fitted(spark):
    train = spark.createDataFrame(TF.training_rows())
    return scoring.fit(train, T.SPEC)


@pytest.fixture()
def tickets(spark, tmp_dir):
    return src.read_delimited(spark, write_lines(f"{tmp_dir}/t.csv", TF.ticket_lines()))


def test_fitted_state(fitted):
    assert set(fitted.fill) == set(T.RULES.numeric + T.RULES.categorical)
    assert sorted(fitted.labels) == ["否", "是"]
    rf = [s for s in fitted.model.stages if type(s).__name__ == "RandomForestClassificationModel"][0]
    assert (rf.getNumTrees, rf.getMaxDepth(), rf.getFeatureSubsetStrategy()) == (100, 8, "onethird")


def test_vocabulary_bound_stops_the_fit(spark):
    """Category vocabularies ship with the model to every task: their size is
    counted in the fill-value pass and bounded before anything is fitted."""
    from dataclasses import replace
    from selfmend.operators import stats
    train = spark.createDataFrame([("a", 1.0, "y"), ("b", 2.0, "n"), ("b", None, "y"), (None, 4.0, "n")],
                                  "c string, v double, lab string")
    fill, sizes = stats.fill_values_and_sizes(train, ["v"], ["c"])
    assert fill == {"v": 7.0 / 3, "c": "b"} and sizes == {"c": 2}
    spec = scoring.ScoringSpec(RuleSet((Range("v", 0, 10), OneOf("c", ("a", "b")))), "lab").exact(max_depth=1)
    with pytest.raises(ValueError, match="max_categories=1"):
        scoring.fit(train, replace(spec, max_categories=1))
    assert scoring.fit(train, replace(spec, max_categories=2)).fill == fill


def test_label_indexing_joint_or_separate(spark):
    """'error': the label is indexed with the categories (one pass); 'keep':
    it has its own indexer, so it still has exactly its two classes."""
    from dataclasses import replace
    from pyspark.ml.feature import StringIndexerModel
    train = spark.createDataFrame([("a", 1.0, "y"), ("b", 2.0, "n"), ("b", 3.0, "y"), ("a", 4.0, "y")],
                                  "c string, v double, lab string")
    spec = scoring.ScoringSpec(RuleSet((Range("v", 0, 10), OneOf("c", ("a", "b")))), "lab").exact(max_depth=1)
    for mode, n_indexers in (("error", 1), ("keep", 2)):
        f = scoring.fit(train, replace(spec, handle_invalid=mode))
        assert sum(isinstance(m, StringIndexerModel) for m in f.model.stages) == n_indexers
        assert f.labels == ["y", "n"]
        rf = [m for m in f.model.stages if type(m).__name__ == "RandomForestClassificationModel"][0]
        assert rf.numClasses == 2
        out = scoring.score(train.drop("lab"), spec, f).collect()
        assert len(out) == 4 and all(0.0 <= r["probability"] <= 1.0 for r in out)


def test_score_keeps_every_input_row_and_column(spark, fitted, tickets):
    out = scoring.score(tickets, T.SPEC, fitted)
    assert out.columns == TF.HEADER + ["prediction", "predictedLabel", "probability"]
    rows = out.collect()
    assert len(rows) == TF.N
    # input values unchanged, blanks stay ''
    assert sorted(r["区县"] for r in rows) == sorted(r["区县"] for r in tickets.collect())
    for r in rows:
        assert 0.0 <= r["probability"] <= 1.0
        assert r["prediction"] == (1.0 if r["probability"] > 0.5 else r["prediction"])
        assert r["predictedLabel"] == fitted.labels[int(r["prediction"])]


def test_score_plan_is_narrow(fitted, tickets):
    plan = scoring.score(tickets, T.SPEC, fitted)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_unseen_category_error_and_keep(spark):
    rules = RuleSet((Range("n", 0, 10), OneOf("c", ("a", "b", "z"))))
    train = spark.createDataFrame([("1", "a", "y"), ("2", "b", "n"), ("3", "a", "y"), ("4", "b", "n")],
                                  "n string, c string, lab string")
    test = spark.createDataFrame([("5", "z")], "n string, c string")
    spec = scoring.ScoringSpec(rules, "lab", num_trees=3, max_depth=2)
    f = scoring.fit(train, spec)
    with pytest.raises(Exception):
        scoring.score(test, spec, f).collect()
    keep = scoring.ScoringSpec(rules, "lab", num_trees=3, max_depth=2, handle_invalid="keep")
    fk = scoring.fit(train, keep)
    assert scoring.score(test, keep, fk).count() == 1


def test_constant_column_scales_to_half_and_no_clamping(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    m = features.fit_features(df, ["a", "b"], [])
    new = spark.createDataFrame([(7.0, 9.0)], "a double, b double")
    v = m.transform(new).select(vector_to_array(features.FEATURES).alias("v")).first()["v"]
    assert v == [3.0, 0.5]


def test_label_encode_order_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "x string")
    m = features.label_encoder(["x"]).fit(df)
    assert list(m.labelsArray[0]) == ["c", "a", "b"]


def test_one_hot_keeps_all_categories(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "x string")
    idx = features.label_encoder(["x"]).fit(df).transform(df)
    oh = features.one_hot_encoder(["x"]).fit(idx).transform(idx)
    assert oh.select(vector_to_array("x_t_t").alias("v")).first()["v"] == [1.0, 0.0]


def test_model_roundtrip(spark, fitted, tickets, tmp_dir):
    fitted.save(spark, f"{tmp_dir}/model")
    loaded = scoring.Fitted.load(spark, f"{tmp_dir}/model")
    assert loaded.fill == fitted.fill
    a = scoring.score(tickets, T.SPEC, fitted).select("问题点编号", "probability").collect()
    b = scoring.score(tickets, T.SPEC, loaded).select("问题点编号", "probability").collect()
    assert sorted(a) == sorted(b)


def _results(rows):
    return rows, "id string, prediction double, predictedLabel string, probability double"


def test_join_by_row_id_attaches_each_row_its_own_result(spark):
    """Duplicated and blank ids, equal rows: one output row per input row,
    each with the result computed from it."""
    left = attach.with_row_ids(spark.createDataFrame(
        [("1", "x"), ("1", "y"), ("", "b1"), ("", "b2"), ("3", "z"), ("1", "x"), (None, None)], "id string, v string"))
    res = left.where("v <> 'z' OR v IS NULL").select(
        attach.ROW_ID, "id", F.lit(1.0).alias("prediction"), F.lit("A").alias("predictedLabel"),
        (F.length(F.coalesce("v", F.lit("")))).cast("double").alias("probability"))
    out = attach.join_by_row_id(left, res)
    assert out.columns == ["id", "v", "prediction", "predictedLabel", "probability"]
    assert sorted([(r["id"], r["v"], r["probability"]) for r in out.collect()], key=repr) == sorted([
        ("", "b1", 2.0), ("", "b2", 2.0), ("1", "x", 1.0), ("1", "x", 1.0), ("1", "y", 1.0), ("3", "z", None),
        (None, None, 0.0)], key=repr)


def test_join_on_id_refuses_differing_results(spark):
    left = spark.createDataFrame([("7", "x"), ("7", "y"), ("", "b"), (None, "n"), ("8", "z")], "id string, v string")
    same = spark.createDataFrame(*_results([("7", 1.0, "A", 0.9), ("7", 1.0, "A", 0.9), ("", 0.0, "B", 0.2), (None, 0.0, "B", 0.1)]))
    out = attach.join_results(left, same, "id")
    assert out.columns == ["id", "v", "prediction", "predictedLabel", "probability"]
    assert sorted([(r["id"], r["v"], r["probability"]) for r in out.collect()], key=repr) == sorted([
        ("7", "x", 0.9), ("7", "y", 0.9), ("", "b", 0.2), (None, "n", 0.1), ("8", "z", None)], key=repr)
    differing = spark.createDataFrame(*_results([("7", 1.0, "A", 0.9), ("7", 0.0, "B", 0.1)]))
    with pytest.raises(ValueError, match="differing results"):
        attach.join_results(left, differing, "id")


def test_number_of_files_is_the_callers_choice(spark, tmp_dir):
    df = spark.range(0, 40, 1, 4).select(F.col("id").cast("string").alias("v"))
    for n in (1, 3):
        sinks.write_csv_header(df, f"{tmp_dir}/n{n}", n_files=n)
        back = spark.read.option("header", True).csv(f"{tmp_dir}/n{n}")
        assert len(back.inputFiles()) == n and back.count() == 40
    sinks.write_csv_header(df, f"{tmp_dir}/all")
    assert len(spark.read.option("header", True).csv(f"{tmp_dir}/all").inputFiles()) == 4


def test_forest_does_not_depend_on_input_partitions(spark):
    """The same rows in other partitions and another order: the same forest."""
    rows = spark.range(0, 2000).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 97).cast("double").alias("n"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("c"),
        F.when((F.col("id") * 7919) % 13 < 6, F.lit("y")).otherwise(F.lit("n")).alias("lab"))
    spec = scoring.ScoringSpec(RuleSet((Range("n", 0, 100), OneOf("c", ("a", "b", "c"))), id="id"), "lab",
                               num_trees=15, max_depth=6, training_partitions=5)
    got = []
    for df in (rows.coalesce(1), rows.repartition(11), rows.orderBy(F.desc("n")).coalesce(3)):
        fitted = scoring.fit(df, spec)
        assert fitted.training_partitions == 5
        got.append(sorted((r["id"], r["probability"]) for r in scoring.score(rows.drop("lab"), spec, fitted).collect()))
    assert got[0] == got[1] == got[2]


def test_forest_is_the_same_on_four_and_sixteen_cores(tmp_dir):
    """Two sessions of different size train on the same file: equal predictions."""
    import subprocess
    import sys
    from conftest import ROOT
    code = """
import sys; sys.path.insert(0, %r)
from dataclasses import replace
from selfmend.plans import scoring, standins as S
from selfmend.session import build_session
from pyspark.sql import functions as F
spark = build_session(sys.argv[1], shuffle_partitions=int(sys.argv[2]))
spec = replace(S.ORDERS_SPEC, num_trees=10)
orders = S.table(spark, "/root/testdata/sf0.001", "orders")
text = orders.select(*S.orders_text_columns(orders))
out = scoring.score(text, spec, scoring.fit(S.orders_training(text), spec))
print("RESULT", out.agg(F.count("*"), F.sum(F.xxhash64("o_orderkey", "prediction", "probability") %% 1000003)).first())
""" % ROOT
    got = [next(x for x in subprocess.run([sys.executable, "-c", code, master, n], capture_output=True, text=True,
                                          timeout=300, check=True).stdout.splitlines() if x.startswith("RESULT"))
           for master, n in (("local[4]", "4"), ("local[16]", "16"))]
    assert got[0] == got[1]


def test_training_is_as_wide_as_its_data(spark):
    assert [scoring.partitions_for(n) for n in (0, 100, 800_001, 10_000_000)] == [8, 8, 9, 100]
    wide = spark.range(0, 10_000_000).select((F.col("id") % 1000).cast("double").alias("n"))
    plan = scoring.dealt(wide, scoring.partitions_for(10_000_000))._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and ", 100)" in plan and "partial_count" in plan
    train = spark.createDataFrame([("1", "a", "y"), ("2", "b", "n")], "n string, c string, lab string")
    spec = scoring.ScoringSpec(RuleSet((Range("n", 0, 10), OneOf("c", ("a", "b")))), "lab", num_trees=2, max_depth=2)
    assert scoring.fit(train, spec).training_partitions == 8


def test_unbagged_trees_learn_from_distinct_rows_bagged_ones_from_all(spark, monkeypatch):
    """Rows are told apart by what is learnt from, not by their ids; the
    leaves' shares are those of all rows; node ids are not kept per row."""
    from pyspark.ml.classification import RandomForestClassifier
    met, fit = [], RandomForestClassifier.fit

    def fit_and_note(self, df, *a):
        met.append((df.count(), self.getOrDefault("cacheNodeIds"), "id" in df.columns))
        return fit(self, df, *a)

    monkeypatch.setattr(RandomForestClassifier, "fit", fit_and_note)
    train = spark.createDataFrame([(i, "a" if i % 3 else "b", "y" if i % 3 and i % 5 else "n") for i in range(3000)], "id long, c string, l string")
    spec = scoring.ScoringSpec(RuleSet((OneOf("c", ("a", "b")),), id="id"), "l", num_trees=3, max_depth=2)
    fitted = scoring.fit(train, spec.exact(2))
    assert met.pop() == (3, False, False)                       # (a, y), (a, n), (b, n)
    got = {r["c"]: r["probability"] for r in scoring.score(train, spec.exact(2), fitted).select("c", "probability").distinct().collect()}
    first = fitted.labels[1] == "y"
    want = {c: sum(l == "y" for k, l in rows if k == c) / sum(k == c for k, _ in rows)
            for rows in [[(r["c"], r["l"]) for r in train.collect()]] for c in "ab"}
    assert all(abs(got[c] - (want[c] if first else 1 - want[c])) < 1e-12 for c in "ab")
    scoring.fit(train, spec)
    assert met.pop() == (3000, False, False)


def _many_rows(spark, n=20_000):
    """Two numerics (one of few values, one of many, and a heavy one), a category, a label that hangs on all."""
    draw = [F.pmod(F.xxhash64(F.col("id"), F.lit(k)), F.lit(1000)) / 1000 for k in range(4)]
    x = F.when(F.col("id") % 4 == 0, F.lit(3.0)).otherwise(draw[0] * draw[0] * 50)
    c = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (draw[1] * 3 + 1).cast("int"))
    df = spark.range(0, n, 1, 4).select(F.floor(draw[2] * 7).cast("double").alias("few"), x.alias("many"), c.alias("c"), draw[3].alias("u"))
    p = F.lit(0.15) + 0.1 * (F.col("few") / 7) + F.when(F.col("many") > 5, 0.3).otherwise(0.0) + F.when(F.col("c") == "b", 0.3).otherwise(0.0)
    return df.withColumn("lab", F.when(F.col("u") < p, "y").otherwise("n")).drop("u")


MANY_SPEC = scoring.ScoringSpec(RuleSet((Range("few", 0, 10), Range("many", 0, 100), OneOf("c", ("a", "b", "c")))), "lab", num_trees=20, max_depth=5)


def test_many_rows_are_bagged_by_points(spark, monkeypatch, tmp_dir):
    """Beyond ``BY_ROW`` rows no tree meets every row, every row is drawn
    nevertheless, and the forest is one as MLlib grows by row."""
    from pyspark.ml.classification import RandomForestClassifier
    from selfmend.operators import points
    rows = _many_rows(spark).localCheckpoint()
    by_row = scoring.fit(rows, MANY_SPEC)
    met, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, *a: met.append(df.count()) or fit(self, df, *a))
    monkeypatch.setattr(scoring, "BY_ROW", 1000)
    learnt, learn = [], points.learn
    monkeypatch.setattr(points, "learn", lambda learner, counted, *a: learnt.append(counted.agg(F.sum("n"), F.count("*")).first()) or learn(learner, counted, *a))
    fits = scoring.fit_seeds(rows, MANY_SPEC, (10, 20))
    assert met == [] and [n for n, _ in learnt] == [20_000, 20_000] and learnt[0][1] <= 7 * 32 * 3 * 2
    got = scoring.score(rows, MANY_SPEC, fits[0]).select("few", "many", "c", F.col("probability").alias("p"))
    want = scoring.score(rows, MANY_SPEC, by_row).select("few", "many", "c", F.col("probability").alias("q"))
    both = got.distinct().join(want.distinct(), ["few", "many", "c"]).agg(F.avg(F.abs(F.col("p") - F.col("q"))), F.corr("p", "q")).first()
    assert both[0] < 0.05 and both[1] > 0.95                          # forests by row of two seeds: up to 0.029, 0.978
    forest, other, plain = [next(m for m in f.model.stages if hasattr(m, "trees")) for f in (*fits, by_row)]
    for f in (forest, other):
        assert (f.getNumTrees, f.getMaxDepth(), f.getFeatureSubsetStrategy(), f.getImpurity(), f.numFeatures, f.numClasses, f.getLabelCol()) == \
            (plain.getNumTrees, plain.getMaxDepth(), plain.getFeatureSubsetStrategy(), plain.getImpurity(), plain.numFeatures, plain.numClasses, plain.getLabelCol())
        assert max(t.depth for t in f.trees) <= 5 and not f.hasSummary
    drawn = [t._call_java("rootNode").impurityStats().count() for t in forest.trees]
    assert len(set(drawn)) > 10 and abs(sum(drawn) / 20 - 20_000) < 5 * (20_000 / 20) ** 0.5        # Poisson(20,000) each
    assert (forest.getSeed(), other.getSeed()) == (10, 20) and forest.toDebugString.split("\n")[1:] != other.toDebugString.split("\n")[1:]
    again = scoring.fit(rows.orderBy(F.desc("many")).repartition(7), MANY_SPEC)       # other files, another order
    assert again.model.stages[-2].toDebugString.split("\n")[1:] == forest.toDebugString.split("\n")[1:]
    fits[0].save(spark, f"{tmp_dir}/m")
    back = scoring.score(rows, MANY_SPEC, scoring.Fitted.load(spark, f"{tmp_dir}/m"))
    assert back.select("few", "many", "c", "probability").exceptAll(got.withColumnRenamed("p", "probability")).count() == 0
    monkeypatch.setattr(scoring, "MOST_BINS", 100)                    # too many points: by row, as before
    slow = scoring.fit(rows, MANY_SPEC)
    assert met == [20_000] and slow.model.stages[-2].toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:]


def test_a_tree_over_points_is_the_learners(spark):
    """Unbagged, over all features and with the same bins: MLlib's own tree."""
    import numpy as np
    from selfmend.operators import model, points
    rows = _many_rows(spark).withColumn("many", F.floor(F.col("many") / 5) * 1.5).localCheckpoint()
    encoders = features.fit_features(rows, ["few", "many"], ["c"], "lab")
    counted = encoders.transform(scoring.weighed(rows))
    cuts = points.thresholds(counted, scoring.WEIGHT, [0, 1], 32)
    assert points.numeric_slots(counted, 5) == [0, 1] and [len(cuts[i]) for i in (0, 1)] == [6, 10 - 1]
    learner = model.forest(3, 6, "all", 10, bootstrap=False)
    want = model.without_summary(learner.fit(encoders.transform(rows)))
    table = points.points(counted, scoring.WEIGHT, cuts, 5).collect()
    bins = np.array([r["bins"] for r in table], dtype=np.int8).T
    labels, n = np.array([int(r["label"]) for r in table]), np.array([r["n"] for r in table])
    nodes = points.saved(points.grow(bins, labels, n, [7, 10, 2, 2, 2], 2, 6, 5, np.random.default_rng(1)), cuts)
    got = points._loaded(spark, learner, spark.createDataFrame([(i, x) for i in range(3) for x in nodes], points.NODES), 5, 2)
    encoded = encoders.transform(rows.dropDuplicates(["few", "many", "c"]))
    p, q = ({(r["few"], r["many"], r["c"]): (round(r["p"], 9), r["prediction"])
             for r in f.transform(encoded).select("few", "many", "c", "prediction", model.probability_of(1).alias("p")).collect()}
            for f in (got, want))
    assert p == q and len(p) > 100
    assert got.totalNumNodes == want.totalNumNodes
    assert abs(got.featureImportances.toArray() - want.featureImportances.toArray()).max() < 1e-9


def test_bins_of_many_values_are_their_quantiles(spark, monkeypatch):
    """Exact over several partitions, whatever the order; a value that holds many rows is one bin."""
    from selfmend.operators import points
    monkeypatch.setattr(points, "PART_VALUES", 60)
    df = spark.range(0, 5000, 1, 3).select(F.lit(3).alias("slot"), F.when(F.col("id") < 500, F.lit(0.25)).otherwise((F.col("id") % 900) / 900).alias("value"))
    counts = df.groupBy("slot", "value").agg(F.count("*").alias("n"))
    values = sorted(r["value"] for r in df.collect())
    rank = {v: i + 1 for i, v in enumerate(values)}                     # rows up to the value
    ends = [v for v, w in zip(sorted(rank), [None, *sorted(rank)]) if rank[v] * 32 // 5000 > (rank[w] if w is not None else 0) * 32 // 5000 and rank[v] < 5000]
    for c in (counts, counts.orderBy(F.desc("value")).coalesce(1)):
        got = points.quantile_values(c, 32, 900).collect()
        assert sorted(r["value"] for r in got if r["ends"]) == ends and [r["value"] for r in got if r["heavy"]] == [0.25]
    assert 25 <= len(ends) < 31 and 0.25 in ends
    last = points.quantile_values(spark.createDataFrame([(0, i / 100, 1) for i in range(50)] + [(0, 0.9, 50)], "slot int, value double, n long"), 10, 51).collect()
    assert sorted(tuple(r) for r in last) == [(0, v, True, False) for v in (0.09, 0.19, 0.29, 0.39, 0.49)] + [(0, 0.9, False, True)]
    assert [points.features_per_node(s, 7, 100) for s in ("onethird", "all", "sqrt", "log2", "auto", "2", "0.5")] == [3, 7, 3, 3, 3, 2, 4]
    assert points._between(0.1, 0.2) > 0.1 and points._between(1.0, 1.0000000000000002) == 1.0


def test_alike_training_rows_are_spread(spark):
    """Two thirds of the rows are one row: it is dealt in lots over all
    partitions, and the order does not depend on the input's."""
    rows = spark.range(0, 60_000, 1, 5).select(
        F.when(F.col("id") % 3 < 2, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"), F.lit(1.0).alias("n"))
    got = []
    for df in (rows, rows.repartition(3)):
        out = scoring.dealt(df, 10).select("k", F.spark_partition_id().alias("p")).collect()
        sizes = [sum(r["p"] == p for r in out) for p in range(10)]
        assert len(out) == 60_000 and sum(r["k"] is None for r in out) == 40_000 and max(sizes) < 12_000
        got.append([(r["p"], r["k"]) for r in out])
    assert got[0] == got[1]


def test_a_fitted_model_does_not_carry_its_training_frame(spark, fitted):
    forest = [s for s in fitted.model.stages if type(s).__name__ == "RandomForestClassificationModel"][0]
    assert not forest.hasSummary


def test_one_judgement_per_time_and_cell(spark):
    rows = [("t1", "c1", "y"), ("t1", "c1", "n"), ("t1", "c1", "y"), ("t1", "c2", "y"), ("t1", "c2", None), ("t2", "c1", None),
            ("", None, "b"), ("", None, "a"), (None, None, "z")]
    df = spark.createDataFrame(rows, "`time` string, `cgi(x)` string, predictedLabel string").withColumn("n", F.lit(1))
    got = {tuple(r) for r in sinks.judgements(df, "time", "cgi(x)", precedence=("n", "y")).collect()}
    assert got == {("t1", "c1", "n"), ("t1", "c2", "y"), ("t2", "c1", None), ("", None, "a"), (None, None, "z")}
    plan = sinks.judgements(df, "time", "cgi(x)")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and plan.count("Exchange") == 1


def test_evaluation_against_brute_force(spark):
    import random
    from selfmend.operators import evaluation, model
    rng = random.Random(4)
    rows = [(float(rng.random() < 0.3), round(rng.random(), 2), float(rng.choice((0, 1, 2)))) for _ in range(400)]
    rows += [(None, 0.5, 0.0), (1.0, None, 1.0), (0.0, float("nan"), 0.0), (1.0, 1.0, 1.0), (0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "label double, probability double, prediction double")
    r = evaluation.ranking(evaluation.score_histogram(df, bins=1000)).first()
    known = [(y, p) for y, p, _ in rows if y is not None and p is not None and p == p]
    pos, neg = [p for y, p in known if y == 1.0], [p for y, p in known if y != 1.0]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap = sum(sum(x >= p for x in pos) / sum(x >= p for _, x in known) for p in pos) / len(pos)
    assert (r["n_positive"], r["n_negative"]) == (len(pos), len(neg))
    assert abs(r["roc_auc"] - auc) < 1e-9 and abs(r["average_precision"] - ap) < 1e-9
    got = {x["class"]: x for x in evaluation.per_class(model.confusion_matrix(df.where("label IS NOT NULL"))).collect()}
    for c in (0.0, 1.0, 2.0):
        tp = sum(y == c == z for y, _, z in rows)
        n, m = sum(y == c for y, _, _ in rows), sum(z == c and y is not None for y, _, z in rows)
        assert (got[c]["n_right"], got[c]["n_rows"], got[c]["n_predicted"]) == (tp, n, m)
        assert got[c]["recall"] == (tp / n if n else None) and got[c]["precision"] == (tp / m if m else None)
    empty = evaluation.ranking(evaluation.score_histogram(df.where("false"))).first()
    assert tuple(empty) == (0, 0, None, None)
    held = spark.range(0, 5000).select(evaluation.held_out(["id"], 0.2).alias("h")).where("h").count()
    assert 850 < held < 1150


def test_large_vocabularies_are_numbered_as_small_ones(spark, monkeypatch):
    """Many partitions, ties, a hot value, NULLs: the indexer's own order."""
    from selfmend.operators import vocabulary
    monkeypatch.setattr(vocabulary, "PART_VALUES", 50)
    rows = spark.range(0, 6000, 1, 5).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), F.pmod(F.xxhash64("id"), F.lit(700)).cast("string"))).alias("a"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise((F.col("id") % 40).cast("string")).alias("b"), "id")
    table = vocabulary.vocabulary_table(rows, ["a", "b"])
    got = {c: [r["value"] for r in table.where(F.col("field") == c).orderBy("idx").collect()] for c in ("a", "b")}
    small = features.label_encoder(["a", "b"]).fit(rows.na.drop())
    full = features.label_encoder(["a"]).fit(rows)
    assert got["a"] == list(full.labelsArray[0]) and sorted(got["b"]) == sorted(small.labelsArray[1])
    assert sorted(r["idx"] for r in table.where("field = 'a'").collect()) == list(range(len(got["a"])))
    out = vocabulary.index_by_join(rows, table, ["a", "b"], "keep")
    want = {r["id"]: r["a_t"] for r in full.transform(rows).collect()}
    assert {r["id"]: r["a_t"] for r in out.collect()} == want and out.where("b IS NULL AND b_t = 40").count() == rows.where("b IS NULL").count()
    with pytest.raises(Exception, match="not in the vocabulary"):
        vocabulary.index_by_join(rows, table, ["b"]).collect()


def test_a_million_values_are_numbered(spark):
    from selfmend.operators import vocabulary
    rows = spark.range(0, 1_000_000, 1, 8).select(F.col("id").cast("string").alias("v"))
    table = vocabulary.vocabulary_table(rows, ["v"])
    r = table.agg(F.count("*").alias("n"), F.min("idx").alias("low"), F.max("idx").alias("high"), F.count_distinct("idx").alias("d")).first()
    assert tuple(r) == (1_000_000, 0, 999_999, 1_000_000)
    first = [x["value"] for x in table.where("idx < 4").orderBy("idx").collect()]
    assert first == ["0", "1", "10", "100"]


def test_label_vocabulary_is_bounded(spark):
    train = spark.createDataFrame([("a", f"l{i}") for i in range(5)], "c string, lab string")
    spec = scoring.ScoringSpec(RuleSet((OneOf("c", ("a", "b")),)), "lab").exact(max_depth=1)
    with pytest.raises(ValueError, match="lab"):
        scoring.fit(train, spec)
    with pytest.raises(ValueError, match="max_categories=3"):
        features.fit_label_encoder(train, ["lab"], 3)


def test_carry_row_is_one_to_one(spark):
    df = spark.createDataFrame([("1", "x"), ("1", "x")], "id string, v string")
    out = attach.expand_row(attach.carry_row(df, [F.lit(1.0).alias("prediction")]), ["prediction"])
    assert out.count() == 2 and out.columns == ["id", "v", "prediction"]


def test_sinks_roundtrip(spark, fitted, tickets, tmp_dir):
    out = scoring.score(tickets, T.SPEC, fitted)
    sinks.write_delimited_text(out, f"{tmp_dir}/txt", columns=TF.HEADER + ["predictedLabel"])
    lines = [r["value"] for r in spark.read.text(f"{tmp_dir}/txt").collect()]
    assert len(lines) == TF.N and all(line.count(",") == len(TF.HEADER) for line in lines)
    sinks.write_csv_header(out, f"{tmp_dir}/csv", n_files=1)
    back = spark.read.option("header", True).csv(f"{tmp_dir}/csv")
    assert back.count() == TF.N and back.columns == out.columns
    assert len(back.inputFiles()) == 1
    sinks.write_json(out, f"{tmp_dir}/json")
    assert spark.read.json(f"{tmp_dir}/json").count() == TF.N
    sinks.write_time_cell_parquet(out, f"{tmp_dir}/pq", T.TIME, T.CELL)
    assert spark.read.parquet(f"{tmp_dir}/pq").columns == [T.TIME, T.CELL, "predictedLabel"]
    sinks.write_json(out.withColumn("source_file", F.lit("f1.csv")), f"{tmp_dir}/per", partition_by="source_file")
    assert spark.read.json(f"{tmp_dir}/per").select("source_file").distinct().count() == 1


def test_forest_matches_tree_by_tree_brute_force(spark, fitted, tickets):
    """The scored probability equals the normalised sum of every tree's leaf
    class shares, recomputed per row in Python on a small fixture."""
    from pyspark.ml import PipelineModel
    stages = fitted.model.stages
    rf = [s for s in stages if type(s).__name__ == "RandomForestClassificationModel"][0]
    feats = PipelineModel(stages=[s for s in stages if s is not rf and type(s).__name__ != "IndexToString"])
    types = dict((f.name, f.dataType) for f in tickets.schema.fields)
    checked = tickets.select("问题点编号", *[r.checked(types[r.column]) for r in T.RULES.active()])
    from selfmend.operators import quality
    vecs = {r["问题点编号"]: r["features"] for r in
            feats.transform(quality.fill_nulls(checked, fitted.fill)).select("问题点编号", "features").collect()}
    scored = {r["问题点编号"]: (r["prediction"], r["probability"]) for r in
              scoring.score(tickets, T.SPEC, fitted).collect()}
    assert set(vecs) == set(scored)
    for key, v in vecs.items():
        votes = [0.0, 0.0]
        for tree in rf.trees:
            p = tree.predictProbability(v)
            votes[0] += p[0]
            votes[1] += p[1]
        p1 = votes[1] / (votes[0] + votes[1])
        pred, prob = scored[key]
        assert abs(prob - p1) < 1e-12
        assert pred == (1.0 if votes[1] > votes[0] else 0.0)

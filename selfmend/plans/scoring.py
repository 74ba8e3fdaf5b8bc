"""Train once, score many: the end-to-end flow (F8 + M2 ... M7).

``fit``   typed training rows -> fill values (one aggregate) -> one
          ``PipelineModel`` (features, forest, label decoder).
``score`` one lazy DataFrame function, no actions: validate -> fill -> encode
          -> forest -> decode, with the input row carried through (J3). It is
          a narrow plan -- every partition is scored on its own, so it scales
          with the executors and never shuffles. Batch jobs and the streaming
          job call the same function.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from selfmend.functions.numeric import strict_double
from selfmend.functions.rules import RuleSet
from selfmend.operators import attach, features, model, points, quality, stats


@dataclass(frozen=True)
class ScoringSpec:
    rules: RuleSet
    label: str
    num_trees: int = 100
    max_depth: int = 8
    subset: str = "onethird"
    seed: int = 10
    bootstrap: bool = True
    handle_invalid: str = "error"     # unseen category: 'error' (reference) or 'keep'
    validate_training: bool = False   # the reference trained on unvalidated rows
    max_categories: int | None = None  # vocabulary bound per category and for the label; see ``vocabulary_bound``
    training_partitions: int | None = None    # default: by the number of rows; see ``partitions_for``

    @property
    def numeric(self):
        return self.rules.numeric

    @property
    def categorical(self):
        return self.rules.categorical

    @property
    def vocabulary_bound(self) -> int:
        """The bound given, else the largest number of values a rule permits."""
        if self.max_categories is not None:
            return self.max_categories
        permitted = [len(self.rules.rule(c).values) for c in self.categorical if hasattr(self.rules.rule(c), "values")]
        return max([2, *permitted])

    def exact(self, max_depth: int = 4) -> "ScoringSpec":
        """One unbagged tree over all features: leaves hold exact group class
        shares, which makes the model checkable against SQL."""
        return replace(self, num_trees=1, bootstrap=False, subset="all", max_depth=max_depth)


@dataclass
class Fitted:
    model: PipelineModel
    fill: dict = field(default_factory=dict)
    training_partitions: int | None = None

    @property
    def labels(self) -> list[str]:
        return list(self.model.stages[-1].getLabels())

    def save(self, spark: SparkSession, path: str) -> None:
        """M6: model + fill values under one shared path."""
        model.save_model(self.model, f"{path}/model")
        state = {"fill": self.fill, "training_partitions": self.training_partitions}
        spark.createDataFrame([(json.dumps(state, ensure_ascii=False),)], "fill string") \
            .coalesce(1).write.mode("overwrite").text(f"{path}/fill")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Fitted":
        state = json.loads(spark.read.text(f"{path}/fill").first()["value"])
        return Fitted(model.load_model(f"{path}/model"), state["fill"], state["training_partitions"])


def prepare_training(df: DataFrame, spec: ScoringSpec, keep=()) -> DataFrame:
    """Training columns typed: numerics strict-parsed (NaN/blank -> NULL),
    categorical blanks -> NULL; with ``validate_training`` the rules run too."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    if spec.validate_training:
        cols = [r.checked(types[r.column]) for r in spec.rules.active()]
    else:
        cols = [strict_double(F.col(c), types[c]).alias(c) for c in spec.numeric]
        cols += [F.when(F.trim(F.col(c).cast("string")) != "", F.col(c).cast("string")).alias(c)
                 for c in spec.categorical]
    label = F.col(spec.label).cast("string")
    return df.select(*[F.col(c) for c in keep], *cols,
                     F.when(F.trim(label) != "", label).alias(spec.label))


@contextmanager
def persisted(df: DataFrame):
    """``df`` kept (memory, spilling to disk) for several passes; a lost
    executor's blocks are recomputed from lineage."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


#: Training rows of a partition, the least number of partitions, and copies of
#: one row that are dealt together.
ROWS_PER_PARTITION, LEAST_PARTITIONS, COPIES = 100_000, 8, 1024
WEIGHT = "_weight"
#: Training rows up to which bagging draws for each row, and the most bins that
#: all points together may have (points x features) for bagging to draw for points.
BY_ROW, MOST_BINS = 1_000_000, 20_000_000


def partitions_for(n_rows: int) -> int:
    """Training is as wide as its data, whatever the cluster: the number of
    partitions is part of the model, as bagging draws per partition."""
    return max(LEAST_PARTITIONS, math.ceil(n_rows / ROWS_PER_PARTITION))


def _placed(df: DataFrame, columns: list[str], partitions: int) -> DataFrame:
    return (df.withColumn("_order", F.xxhash64(*columns)).repartition(partitions, "_order")
            .sortWithinPartitions("_order", *columns))


def weighed(typed: DataFrame) -> DataFrame:
    """Each distinct row once, with its number as ``_weight``."""
    return typed.groupBy(*typed.columns).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))


def dealt(typed: DataFrame, partitions: int) -> DataFrame:
    """The rows in ``partitions`` partitions and an order that depend on the
    rows alone, not on the input's files or the cluster's size.

    Equal rows are counted first (a partial aggregate), cut into lots of
    ``COPIES``, and dealt by a hash of the values and the lot: rows that are
    alike are spread over all partitions, and shuffled as counts."""
    columns = typed.columns
    lots = (typed.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES)))))
    placed = _placed(lots, [*columns, "_lot"], partitions)
    copies = F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES), F.col("_n") - F.col("_lot") * COPIES))
    return placed.withColumn("_copy", F.explode(copies)).select(*columns)


def _filled(typed: DataFrame, spec: ScoringSpec) -> tuple[dict, DataFrame, int]:
    """A5 + P8 on typed rows: fill values (vocabulary sizes, the label's too,
    checked, and the rows counted, in the same pass), then the filled rows that
    have a label, and how many rows there are."""
    fill, sizes, n_rows = stats.fill_values_sizes_rows(typed, spec.numeric, [*spec.categorical, spec.label])
    features.check_vocabulary(sizes, spec.vocabulary_bound)
    fill = {c: v for c, v in fill.items() if c != spec.label}
    return fill, quality.fill_nulls(typed, fill).where(F.col(spec.label).isNotNull()), n_rows


def fit_features(train: DataFrame, spec: ScoringSpec, keep=()) -> tuple[dict, PipelineModel]:
    """F8 alone: fill values and the fitted feature pipeline (F1-F7 with the
    label index), over the persisted training rows. Counts, minima and maxima
    do not depend on where rows are, so nothing is dealt."""
    with persisted(prepare_training(train, spec, keep)) as typed:
        fill, filled, _ = _filled(typed, spec)
        return fill, features.fit_features(filled, spec.numeric, spec.categorical, spec.label,
                                           spec.handle_invalid)


def _bagged_by_points(filled: DataFrame, encoders: PipelineModel, learners: list) -> list | None:
    """The bagged forests learnt from the points of the rows (``points``), or
    None where there are too many for a task to hold, or one class alone, of
    which the learner itself says that it learns nothing."""
    n_classes = len(features.label_labels(encoders))
    if n_classes < 2:
        return None
    with persisted(weighed(filled)) as groups:
        encoded = encoders.transform(groups)
        n_features = encoded.schema[features.FEATURES].metadata["ml_attr"]["num_attrs"]
        cuts = points.thresholds(encoded, WEIGHT, points.numeric_slots(encoded, n_features), learners[0].getMaxBins())
        with persisted(points.points(encoded, WEIGHT, cuts, n_features)) as counted:
            if counted.count() * n_features > MOST_BINS:
                return None
            return [points.learn(x, counted, cuts, n_features, n_classes) for x in learners]


def fit(train: DataFrame, spec: ScoringSpec) -> Fitted:
    """F8 + M2: fill values, then one Pipeline fit (vocabularies, min/max,
    label index, forest). Rows without a label are not used for fitting.

    The source is parsed once. The fill-value pass also counts each vocabulary
    -- one above ``spec.vocabulary_bound`` stops the fit -- and the rows, from
    which ``partitions_for`` says over how many partitions they are ``dealt``.
    Only the columns that are learnt from are kept: rows alike in them are
    interchangeable. Unbagged trees count rows and nothing else, so they learn
    from the distinct rows, ``weighed``; bagging draws for each row, or for more
    than ``BY_ROW`` rows for all rows of a point at once.
    """
    return fit_seeds(train, spec, [spec.seed])[0]


def fit_seeds(train: DataFrame, spec: ScoringSpec, seeds: Sequence[int]) -> list[Fitted]:
    """``fit`` with each of ``seeds``: all but the forest is the same for all."""
    with persisted(prepare_training(train, spec)) as typed:
        fill, filled, n_rows = _filled(typed, spec)
        encoders = Pipeline(stages=features.feature_stages(spec.numeric, spec.categorical, spec.label, spec.handle_invalid)).fit(filled)
        learners = [model.forest(spec.num_trees, spec.max_depth, spec.subset, seed, bootstrap=spec.bootstrap) for seed in seeds]
        forests = None
        if spec.bootstrap:
            partitions = spec.training_partitions or partitions_for(n_rows)
            if n_rows > BY_ROW:
                forests = _bagged_by_points(filled, encoders, learners)
            rows = dealt(filled, partitions)
        else:
            for learner in learners:
                learner.setWeightCol(WEIGHT)
            groups = weighed(filled)
            partitions = spec.training_partitions or partitions_for(groups.count())
            rows = _placed(groups, filled.columns, partitions).drop("_order")
        if forests is None:
            with persisted(rows):
                encoded = encoders.transform(rows)
                forests = [learner.fit(encoded) for learner in learners]
    out = []
    for forest in forests:
        fitted = PipelineModel(stages=[*encoders.stages, forest])
        decoder = model.label_decoder(features.label_labels(fitted))
        kept = [model.without_summary(s) for s in fitted.stages]
        out.append(Fitted(PipelineModel(stages=[*kept, decoder]), dict(fill), partitions))
    return out


def unseen(columns: Mapping[str, Column], spec: ScoringSpec, fitted: Fitted) -> Column:
    """True for rows that ``score`` cannot encode under ``handle_invalid='error'``:
    a category (of the text ``columns``) whose checked and filled value is
    outside the fitted vocabulary (or still NULL). One ``InSet`` lookup per
    category; the vocabularies are bounded (``vocabulary_bound``)."""
    vocab = features.vocabularies(fitted.model)
    out = F.lit(False)
    for c in spec.categorical:
        v = spec.rules.rule(c).checked(source=columns[c])
        if fitted.fill.get(c) is not None:
            v = F.coalesce(v, F.lit(fitted.fill[c]))
        out = out | v.isNull() | ~v.isin(vocab[c])
    return out


def score(df: DataFrame, spec: ScoringSpec, fitted: Fitted) -> DataFrame:
    """M7: input columns + ``prediction``, ``predictedLabel``, ``probability``
    (P of class index 1). One output row per input row; lazy."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    checked = [r.checked(types[r.column]) for r in spec.rules.active()]     # P7
    carried = attach.carry_row(df, checked)
    filled = quality.fill_nulls(carried, fitted.fill)                        # P8
    scored = fitted.model.transform(filled)
    return attach.expand_row(scored, ["prediction", "predictedLabel",
                                      model.probability_of(1).alias("probability")])

"""Feature operators as Spark ML stages.

The reference chained 16 single-column indexers (16 fit jobs) and 16
one-hot encoders; here each is one multi-column stage, so fitting all
vocabularies is one pass. Column naming follows the reference: a category
``x`` is indexed to ``x_t`` and one-hot encoded to ``x_t_t``; numerics are
assembled to ``num_feats`` and scaled to ``num_feats_t``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (MinMaxScaler, OneHotEncoder, StringIndexer, StringIndexerModel,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from selfmend.operators import stats

NUM_VEC, NUM_SCALED, LABEL, FEATURES = "num_feats", "num_feats_t", "label", "features"


def indexed(c: str) -> str:
    return c + "_t"


def one_hot(c: str) -> str:
    return c + "_t_t"


def numeric_assembler(numeric: Sequence[str]) -> VectorAssembler:
    """numerics -> ``num_feats`` (NULL input is an error: fill first)."""
    return VectorAssembler(inputCols=list(numeric), outputCol=NUM_VEC, handleInvalid="error")


def minmax_scaler() -> MinMaxScaler:
    """F2: scale to [0, 1] with the training min/max (not clamped; constant -> 0.5)."""
    return MinMaxScaler(inputCol=NUM_VEC, outputCol=NUM_SCALED)


def label_encoder(categorical: Sequence[str], handle_invalid: str = "error") -> StringIndexer:
    """every category -> index by descending frequency (ties alphabetical).
    ``handle_invalid='error'`` fails on an unseen value; ``'keep'`` gives it
    one extra index."""
    return StringIndexer(inputCols=list(categorical), outputCols=[indexed(c) for c in categorical],
                         stringOrderType="frequencyDesc", handleInvalid=handle_invalid)


def one_hot_encoder(categorical: Sequence[str], handle_invalid: str = "error") -> OneHotEncoder:
    """indices -> one-hot vectors keeping every category (``dropLast=False``)."""
    return OneHotEncoder(inputCols=[indexed(c) for c in categorical],
                         outputCols=[one_hot(c) for c in categorical],
                         dropLast=False, handleInvalid=handle_invalid)


def label_indexer(label: str) -> StringIndexer:
    """label string -> ``label`` index by descending frequency."""
    return StringIndexer(inputCol=label, outputCol=LABEL, stringOrderType="frequencyDesc")


def feature_assembler(numeric: Sequence[str], categorical: Sequence[str]) -> VectorAssembler:
    """scaled numerics first, then the one-hot blocks in column order."""
    inputs = ([NUM_SCALED] if numeric else []) + [one_hot(c) for c in categorical]
    return VectorAssembler(inputCols=inputs, outputCol=FEATURES)


def feature_stages(numeric: Sequence[str], categorical: Sequence[str],
                   label: str | None = None, handle_invalid: str = "error") -> list:
    """F8's stage list: F1, F2, F3, F5, F6, F7 (numeric / label parts optional).

    With ``handle_invalid='error'`` the label is indexed by the categories'
    multi-column indexer (same order rule, one counting pass for all); with
    ``'keep'`` it keeps its own indexer, since 'keep' would give the label an
    extra class."""
    stages = []
    if numeric:
        stages += [numeric_assembler(numeric), minmax_scaler()]
    joint = bool(label and categorical and handle_invalid == "error")
    if categorical:
        indexer = label_encoder(categorical, handle_invalid)
        if joint:
            indexer.setInputCols(list(categorical) + [label]).setOutputCols(
                [indexed(c) for c in categorical] + [LABEL])
        stages += [indexer, one_hot_encoder(categorical, handle_invalid)]
    if label and not joint:
        stages.append(label_indexer(label))
    stages.append(feature_assembler(numeric, categorical))
    return stages


def vocabularies(model: PipelineModel) -> dict[str, list[str]]:
    """Category column -> its fitted vocabulary (index order); the label's is
    left out."""
    out = {}
    for m in model.stages:
        if isinstance(m, StringIndexerModel):
            ins = m.getInputCols() if m.isSet("inputCols") else [m.getInputCol()]
            outs = m.getOutputCols() if m.isSet("outputCols") else [m.getOutputCol()]
            out.update({c: list(v) for c, o, v in zip(ins, outs, m.labelsArray) if o != LABEL})
    return out


def label_labels(model: PipelineModel) -> list[str]:
    """The label vocabulary (index order) of a fitted feature pipeline."""
    for m in model.stages:
        if isinstance(m, StringIndexerModel):
            outs = m.getOutputCols() if m.isSet("outputCols") else [m.getOutputCol()]
            if LABEL in outs:
                return list(m.labelsArray[outs.index(LABEL)])
    raise ValueError("no label index in the pipeline")


def fit_features(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 label: str | None = None, handle_invalid: str = "error") -> PipelineModel:
    """F8: fit the feature pipeline (min/max + vocabularies in one pass each)."""
    return Pipeline(stages=feature_stages(numeric, categorical, label, handle_invalid)).fit(df)


def apply_features(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """transform with fitted state; returns ``keep`` columns + ``features``
    (+ ``label`` when the label column was present). Errors surface at the
    action, they are not swallowed."""
    out = model.transform(df)
    cols = list(keep) + [FEATURES] + ([LABEL] if LABEL in out.columns else [])
    return out.select(*cols)


def labeled_rows(df: DataFrame) -> DataFrame:
    """(label, features) pairs for training."""
    return df.select(LABEL, FEATURES)


def vector_entries(df: DataFrame, id_col: str, vec_col: str, digits: int = 9,
                   keep: Sequence[str] = ()) -> DataFrame:
    """A vector column as rows: (id, ``keep``..., slot, value), one for every
    slot, rounded -- the form in which vectors are compared with SQL."""
    pos = F.posexplode(vector_to_array(F.col(vec_col))).alias("slot", "v")
    cols = [F.col(id_col), *[F.col(c) for c in keep]]
    return df.select(*cols, pos).select(*cols, F.col("slot"), F.round("v", digits).alias("value"))


def one_hot_entries(df: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """One-hot vectors as rows: (id, field, slot, value, size) for the slots
    that are set, with the vector's size; all columns in one pass."""
    fields = [F.struct(F.lit(c).alias("field"), vector_to_array(F.col(one_hot(c))).alias("v")) for c in columns]
    each = df.select(F.col(id_col), F.explode(F.array(*fields)).alias("o"))
    slots = each.select(id_col, "o.field", F.size("o.v").alias("size"), F.posexplode("o.v").alias("slot", "value"))
    return slots.where(F.col("value") != 0).select(id_col, "field", "slot", "value", "size")


def check_vocabulary(sizes: Mapping[str, int], bound: int) -> None:
    """A vocabulary is collected to the driver and ships to every task, and it
    grows with the distinct values of its column: over ``bound`` it is refused."""
    over = {c: n for c, n in sizes.items() if n > bound}
    if over:
        raise ValueError(
            f"categorical columns over max_categories={bound}: {over}; "
            "validate training rows (validate_training=True bounds each vocabulary by its "
            "rule's values) or raise the bound")


def fit_label_encoder(df: DataFrame, columns: Sequence[str], max_categories: int,
                      handle_invalid: str = "error") -> StringIndexerModel:
    """F3/F4 fitted alone: the vocabularies are counted (one partial aggregate)
    and checked before they are collected."""
    sizes = stats.value_counts(df, columns).groupBy("field").agg(F.count(F.lit(1)).alias("n"))
    check_vocabulary({r["field"]: r["n"] for r in sizes.collect()}, max_categories)
    return label_encoder(columns, handle_invalid).fit(df)

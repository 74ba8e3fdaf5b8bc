"""Attaching results to input rows, and the preview limit.

* ``carry_row`` / ``expand_row`` (J3, the scoring path): the input row rides
  through the transformation as one struct column, so every input row gets
  exactly its own result -- no join, no shuffle, no driver zip.
* ``with_row_ids`` / ``join_by_row_id`` (J1+J2): the input is written once with
  a unique row id, scored from that copy, and the results joined back on the
  row id. Ids that repeat or are blank are of no concern, and the key is
  unique on both sides, so no group is larger than one row.
* ``join_results`` (J1+J2 for results that hold only the id): one output row
  per input row. An id with differing results cannot be attached and is an
  error (the reference emitted every pair of such rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selfmend.session import scratch_path

RESULT_COLUMNS = ("prediction", "predictedLabel", "probability")
ROW = "_row"
KEY = "_match_key"
ROW_ID = "_row_id"


def carry_row(df: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
    """Pack all input columns into the ``_row`` struct next to ``extra`` columns."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW), *extra)


def expand_row(df: DataFrame, extra: Sequence[str | Column] = RESULT_COLUMNS) -> DataFrame:
    """The original input columns (original order) followed by ``extra``."""
    return df.select(f"{ROW}.*", *extra)


def with_row_ids(df: DataFrame) -> DataFrame:
    """``df`` with a unique ``_row_id``, written to the shared scratch folder
    and read back, so that every later use sees the same ids."""
    path = scratch_path(df.sparkSession, "row-ids")
    keyed = df.withColumn(ROW_ID, F.monotonically_increasing_id())
    keyed.write.parquet(path)
    return df.sparkSession.read.schema(keyed.schema).parquet(path)


def join_by_row_id(left: DataFrame, results: DataFrame,
                   result_columns: Sequence[str] = RESULT_COLUMNS) -> DataFrame:
    """J1 + J2: all left columns in their order (without ``_row_id``) plus the
    result columns, matched on the row id both sides carry. The result side is
    as large as the input, so the join is pinned to sort-merge."""
    right = results.select(ROW_ID, *[F.col(c) for c in result_columns]).hint("merge")
    joined = left.join(right, ROW_ID, "left")
    return joined.select(*[F.col(f"`{c}`") for c in left.columns if c != ROW_ID], *[F.col(c) for c in result_columns])


def join_results(left: DataFrame, results: DataFrame, id_col: str,
                 result_columns: Sequence[str] = RESULT_COLUMNS) -> DataFrame:
    """J1 + J2 on the id alone: all left columns plus the result columns.

    Equal results of one id count once; an id with differing results raises
    ``ValueError`` before anything is joined. Blank ids match each other, and
    so do NULL ones. The reduced results are a table in the scratch folder, so
    both join sides are plain scans and AQE can split the input rows of an id
    that holds a large part of them.
    """
    spark = left.sparkSession
    path = scratch_path(spark, "results")
    once = results.select(F.col(f"`{id_col}`").cast(left.schema[id_col].dataType).alias(KEY),
                          *[F.col(c) for c in result_columns]).distinct()
    once.write.parquet(path)
    right = spark.read.schema(once.schema).parquet(path)
    clash = right.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(5).collect()
    if clash:
        raise ValueError(f"{id_col} with differing results, e.g. {[r[KEY] for r in clash]}: "
                         "attach by row (with_row_ids) instead")
    joined = left.join(right.hint("merge"), F.col(f"`{id_col}`").eqNullSafe(F.col(KEY)), "left")
    return joined.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(c) for c in result_columns])


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """L1: the first ``n`` rows, no order (a look, not a result)."""
    return df.limit(n)

"""Training statistics: summaries, value counts, modes, fill values, min/max.

Each statistic is one aggregate over one scan. Categorical columns are
unpivoted and counted with a single ``groupBy(field, value)`` -- the partial
aggregate collapses a hot value map-side, so a value holding a third of all
rows costs one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _stack(df: DataFrame, columns: Sequence[str], value_type: str = "string") -> DataFrame:
    """Unpivot ``columns`` into (field, value) rows; NULL values dropped."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).cast(value_type).alias("value"))
        for c in columns])).alias("s")
    return df.select(pairs).select("s.*").where(F.col("value").isNotNull())


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A2: count, mean, stddev (sample), min, max per numeric column, as rows."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(f"n{i}").alias("count"), F.col(f"a{i}").alias("mean"),
                 F.col(f"s{i}").alias("stddev"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(columns)])).alias("s")).select("s.*")


def numeric_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A2 (the part used): one row, the mean of each column, NULLs excluded."""
    return df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns])


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A3: (field, value, n) for every categorical column in one job."""
    return _stack(df, columns).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A4: (field, value, n) of each column's most frequent value; ties -> the
    lowest value. ``min_by`` over the (-n, value) key is a partial aggregate."""
    return _modes_and_sizes(df, columns).drop("n_values")


def _modes_and_sizes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A4 plus ``n_values``, the column's number of distinct values, from the
    same aggregate (partial, so no column's values meet in one task)."""
    vc = value_counts(df, columns)
    best = F.min_by(F.struct("value", "n"), F.struct((-F.col("n")).alias("k"), F.col("value")))
    return (vc.groupBy("field").agg(best.alias("b"), F.count(F.lit(1)).alias("n_values"))
            .select("field", "b.value", "b.n", "n_values"))


_ROW = "__row"


def fill_values_frame(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                      with_sizes: bool = False) -> DataFrame:
    """A5 as rows: (field, num_value, cat_value) -- means of numerics, modes of
    categoricals, computed over the raw (unvalidated) values, NULLs excluded.
    ``with_sizes`` adds ``n_values`` (distinct values of a categorical) and
    ``n_cells`` (rows, of a categorical those with a value).

    One scan: all columns are unpivoted together, a numeric with no value text
    and its number, so it is one key of the same partial aggregate that counts
    the categories' values."""
    cells = [F.struct(F.lit(c).alias("field"), F.lit(None).cast("string").alias("value"),
                      F.col(c).cast("double").alias("x"), F.lit(True).alias("is_number")) for c in numeric]
    cells += [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"),
                       F.lit(None).cast("double").alias("x"), F.lit(False).alias("is_number")) for c in categorical]
    counted = (df.select(F.explode(F.array(*cells)).alias("s")).select("s.*")
               .where(F.col("is_number") | F.col("value").isNotNull())
               .groupBy("field", "is_number", "value")
               .agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("total"), F.count("x").alias("n_x")))
    # a column without any value keeps its row, with nothing to fill
    best = F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value")))
    out = counted.groupBy("field", "is_number").agg(
        (F.sum("total") / F.sum("n_x")).alias("num_value"), best.alias("cat_value"), F.count("value").alias("n_values"),
        F.sum("n").alias("n_cells"))
    out = out.select("field", "num_value", "cat_value", F.when(~F.col("is_number"), F.col("n_values")).alias("n_values"), "n_cells")
    return out if with_sizes else out.drop("n_values", "n_cells")


def fill_values(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> dict:
    """A5: {column: mean or mode}. One small row per column reaches the driver."""
    return fill_values_and_sizes(df, numeric, categorical)[0]


def fill_values_and_sizes(df: DataFrame, numeric: Sequence[str],
                          categorical: Sequence[str]) -> tuple[dict, dict]:
    """A5 plus {categorical column: number of distinct values}, one job."""
    return fill_values_sizes_rows(df, numeric, categorical)[:2]


def fill_values_sizes_rows(df: DataFrame, numeric: Sequence[str],
                           categorical: Sequence[str]) -> tuple[dict, dict, int]:
    """A5, {categorical column: number of distinct values} and the number of
    rows, one job: each row is one cell of a further column."""
    fill, sizes, n_rows = {}, {}, 0
    counted = df.withColumn(_ROW, F.lit(1.0))
    for r in fill_values_frame(counted, [*numeric, _ROW], categorical, with_sizes=True).collect():
        if r["field"] == _ROW:
            n_rows = int(r["n_cells"])
            continue
        fill[r["field"]] = r["num_value"] if r["num_value"] is not None else r["cat_value"]
        if r["n_values"] is not None:
            sizes[r["field"]] = r["n_values"]
    return fill, sizes, n_rows


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, min, max) per numeric column, one aggregate."""
    one = df.agg(*[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(columns)],
                 *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(columns)])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(columns)])).alias("s")).select("s.*")

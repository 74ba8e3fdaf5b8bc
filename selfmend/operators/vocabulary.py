"""Vocabularies beyond what a model may carry.

``features.fit_label_encoder`` collects a vocabulary and ships it to every
task, and refuses one over its bound. Here the vocabulary is a table: values
are counted by a partial aggregate, ranked by falling count and then by value
in a range-partitioned sort, and numbered without passing one task: a row's
index is its place in its partition plus the rows of its column in the
partitions before. Rows take their indices by a join on the value, whose sides
are both shuffled; AQE splits a value that a large part of the rows hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from selfmend.operators import stats
from selfmend.operators.features import indexed
from selfmend.session import scratch_path

#: Distinct values that are numbered in a partition, about.
PART_VALUES = 1_000_000


def vocabulary_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``field, value, n, idx``: of each column every value (NULL is none) and
    its index, from 0, by falling count, ties by value -- as the indexer of
    ``features`` gives it."""
    spark = df.sparkSession
    path = scratch_path(spark, "value-counts")
    stats.value_counts(df, columns).where(F.col("value").isNotNull()).write.parquet(path)
    counts = spark.read.parquet(path)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-counts.count() // PART_VALUES))
    by = ("field", F.desc("n"), "value")
    place = F.monotonically_increasing_id()
    ranked = counts.repartitionByRange(parts, *by).sortWithinPartitions(*by) \
        .withColumn("_part", F.shiftright(place, 33)).withColumn("_at", place.bitwiseAND(F.lit((1 << 33) - 1)))
    path = scratch_path(spark, "ranked-values")
    ranked.write.parquet(path)                      # places are those of this one sort
    ranked = spark.read.parquet(path)
    before = Window.partitionBy("field").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranked.groupBy("field", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))))     # a row per column and partition
    starts = starts.select("field", "_part", (F.col("_before") - F.col("_first")).alias("_offset"))
    return ranked.join(starts.hint("merge"), ["field", "_part"]) \
        .select("field", "value", "n", (F.col("_at") + F.col("_offset")).alias("idx"))


def index_by_join(df: DataFrame, vocabulary: DataFrame, columns: Sequence[str], handle_invalid: str = "error") -> DataFrame:
    """``df`` with ``x_t``, the index of each column ``x`` as a double. A value
    that is not in the vocabulary, or NULL, is an error when the row is
    computed, or with ``'keep'`` gets the index after the last."""
    if handle_invalid not in ("error", "keep"):
        raise ValueError("handle_invalid is 'error' or 'keep'")
    sizes = {r["field"]: r["n"] for r in vocabulary.groupBy("field").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = df.columns
    for c in columns:
        own = vocabulary.where(F.col("field") == c).select(F.col("value").alias("__value"), F.col("idx").cast("double").alias(indexed(c)))
        df = df.join(own.hint("merge"), F.col(f"`{c}`").cast("string") == F.col("__value"), "left").drop("__value")
        unknown = (F.lit(float(sizes.get(c, 0))) if handle_invalid == "keep"
                   else F.raise_error(F.concat(F.lit(f"{c}: not in the vocabulary: "), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NULL")))))
        df = df.withColumn(indexed(c), F.coalesce(F.col(f"`{indexed(c)}`"), unknown.cast("double")))
    return df.select(*[F.col(f"`{c}`") for c in names], *[F.col(f"`{indexed(c)}`") for c in columns])

"""Evaluation on held-out rows (A9 beyond raw counts).

Everything is a partial aggregate over the scored rows: confusion counts per
pair of classes, and a histogram of scores with a fixed number of bins, from
which the areas under the ROC and precision-recall curves follow. What is
ordered or summed after that has as many rows as there are classes or bins,
whatever the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from selfmend.operators.features import LABEL

BINS = 10_000


def held_out(keys: Sequence[str], share: float) -> Column:
    """Whether a row is held out of training: by the MD5 of its key's text
    (NULLs as blanks), so that the split depends on the row alone. ``share``
    counts in thousandths."""
    text = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in keys])
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    return digits % 1000 < round(share * 1000)


def score_histogram(scored: DataFrame, score: str = "probability", label: str = LABEL, positive: float = 1.0,
                    bins: int = BINS) -> DataFrame:
    """``bin, n_positive, n_negative``: rows by score, ``bins`` steps from 0 to
    1. Rows without a score or a label are not counted."""
    at = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).alias("bin")
    known = scored.where(F.col(score).isNotNull() & ~F.isnan(score) & F.col(label).isNotNull())
    return known.groupBy(at).agg(F.count_if(F.col(label) == positive).alias("n_positive"),
                                 F.count_if(F.col(label) != positive).alias("n_negative"))


def ranking(histogram: DataFrame) -> DataFrame:
    """One row: ``n_positive, n_negative, roc_auc`` (a tie within a bin counts a
    half) and ``average_precision`` (precision at each bin, weighted by the
    recall it adds). An area is NULL where a class has no rows."""
    falling = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)     # as many rows as bins
    at = histogram.withColumn("tp", F.sum("n_positive").over(falling)).withColumn("fp", F.sum("n_negative").over(falling))
    p, n = F.sum("n_positive"), F.sum("n_negative")
    wins = F.sum(F.col("n_negative") * (F.col("tp") - F.col("n_positive") / 2))
    precision = F.sum(F.col("n_positive") * F.col("tp") / (F.col("tp") + F.col("fp")))
    out = at.agg(F.coalesce(p, F.lit(0)).alias("n_positive"), F.coalesce(n, F.lit(0)).alias("n_negative"),
                 wins.alias("wins"), precision.alias("precision"))
    return out.select("n_positive", "n_negative",
                      F.when((F.col("n_positive") > 0) & (F.col("n_negative") > 0),
                             F.col("wins") / (F.col("n_positive") * F.col("n_negative"))).alias("roc_auc"),
                      F.when(F.col("n_positive") > 0, F.col("precision") / F.col("n_positive")).alias("average_precision"))


def per_class(confusion: DataFrame) -> DataFrame:
    """From ``label, prediction, n``, one row per class that occurs as either:
    ``class, n_rows, n_predicted, n_right, precision, recall, f1`` (NULL where
    nothing is divided by)."""
    actual = confusion.select(F.col(LABEL).alias("class"), F.col("n").alias("n_rows"), F.lit(0).cast("long").alias("n_predicted"),
                              F.when(F.col(LABEL) == F.col("prediction"), F.col("n")).otherwise(0).alias("n_right"))
    predicted = confusion.select(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("n_rows"),
                                 F.col("n").alias("n_predicted"), F.lit(0).cast("long").alias("n_right"))
    by = actual.unionByName(predicted).groupBy("class").agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_predicted", "n_right")])
    right = F.col("n_right")
    return by.select("class", "n_rows", "n_predicted", "n_right",
                     F.when(F.col("n_predicted") > 0, right / F.col("n_predicted")).alias("precision"),
                     F.when(F.col("n_rows") > 0, right / F.col("n_rows")).alias("recall"),
                     (2 * right / (F.col("n_rows") + F.col("n_predicted"))).alias("f1"))

"""Result sinks. All writers run on the executors (no driver-side frame) and
leave the number of files to the frame's partitions.

``n_files`` (K5) asks for a number of files: the frame is dealt out evenly to
that many tasks before the write. It is the caller's choice and never depends
on the data; ``n_files=1`` means one task, so it is for frames that are small
by construction (a summary). ``partition_by`` (K6) gives one output folder per
source file instead of the reference's per-file result path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _prepare(df: DataFrame, n_files: int | None) -> DataFrame:
    return df if n_files is None else df.repartition(n_files)


def _writer(df: DataFrame, partition_by: Sequence[str] | str | None, mode: str):
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    return w


def delimited_lines(df: DataFrame, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """K1's line: ``str`` of every column joined by ``sep``; NULL prints as
    empty so fields never shift. No trailing blank line."""
    return df.select(F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
                                        for c in columns]).alias("value"))


def write_delimited_text(df: DataFrame, path: str, columns: Sequence[str] | None = None,
                         sep: str = ",", n_files: int | None = None, mode: str = "overwrite") -> None:
    """K1: headerless delimited text (input columns + ``predictedLabel`` by default)."""
    columns = list(columns) if columns is not None else [c for c in df.columns
                                                         if c not in ("prediction", "probability")]
    _writer(_prepare(delimited_lines(df, columns, sep), n_files), None, mode).text(path)


def write_json(df: DataFrame, path: str, n_files: int | None = None,
               partition_by: Sequence[str] | str | None = None, mode: str = "overwrite") -> None:
    """K2: JSON lines."""
    _writer(_prepare(df, n_files), partition_by, mode).json(path)


def write_csv_header(df: DataFrame, path: str, n_files: int | None = None,
                     partition_by: Sequence[str] | str | None = None, mode: str = "overwrite") -> None:
    """K3: UTF-8 CSV with a header; blank stays blank (not ``""``)."""
    (_writer(_prepare(df, n_files), partition_by, mode)
     .option("header", True).option("encoding", "UTF-8").option("emptyValue", "")
     .csv(path))


def write_parquet(df: DataFrame, path: str, n_files: int | None = None,
                  partition_by: Sequence[str] | str | None = None, mode: str = "overwrite") -> None:
    _writer(_prepare(df, n_files), partition_by, mode).parquet(path)


def judgements(df: DataFrame, time_col: str, cell_col: str, label_col: str = "predictedLabel",
               precedence: Sequence[str] = ()) -> DataFrame:
    """One judgement per (time, cell): of differing ones the label that comes
    first in ``precedence``, then (labels not named there) the least; no label
    comes last. Blank and NULL times or cells are keys like others.

    A least value per key, so equal keys are reduced before the shuffle and a
    hot key costs one row per task."""
    label = F.col(f"`{label_col}`")
    rank = F.lit(len(precedence))
    for i, name in reversed(list(enumerate(precedence))):
        rank = F.when(label == F.lit(name), F.lit(i)).otherwise(rank)
    rank = F.when(label.isNull(), F.lit(len(precedence) + 1)).otherwise(rank)
    first = F.min(F.struct(rank.alias("rank"), label.alias("label")))
    return (df.groupBy(F.col(f"`{time_col}`"), F.col(f"`{cell_col}`")).agg(first.alias("_first"))
            .select(F.col(f"`{time_col}`"), F.col(f"`{cell_col}`"), F.col("_first.label").alias(label_col)))


def write_time_cell_parquet(df: DataFrame, path: str, time_col: str, cell_col: str,
                            label_col: str = "predictedLabel", mode: str = "overwrite",
                            precedence: Sequence[str] | None = None) -> None:
    """K4: the documented output contract, judgements by time and cell, as
    Parquet. With a ``precedence`` (an empty one will do) there is one per
    (time, cell); without, the frame's rows are written as they are, for
    frames that hold each key once."""
    if precedence is not None:
        df = judgements(df, time_col, cell_col, label_col, precedence)
    write_parquet(df.select(F.col(f"`{time_col}`"), F.col(f"`{cell_col}`"), F.col(label_col)),
                  path, mode=mode)

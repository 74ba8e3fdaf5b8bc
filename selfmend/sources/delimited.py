"""Delimited text sources.

Ticket files are UTF-8, comma separated, with a header line and **no quoting
or escaping**: every comma splits, blank and trailing blank fields are kept,
and the empty string (not NULL) means "missing". Two equivalent read paths:

* text path  -- ``scan_lines`` -> header lines dropped -> split -> columns
  taken by name, by the layout of the row's file (``layouts``): tolerant of
  concatenated files with repeated headers; empty lines are skipped, as the
  CSV reader skips them. Batch reads and the streaming job use it;
* CSV path   -- ``read_csv_strings``: the CSV reader with quoting off, for
  files that share a header and do not repeat it.

Both keep the header-only file (no rows) and return all-string columns with
blanks as ``''``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from selfmend.functions.files import source_file_name, source_file_path
from selfmend.functions.numeric import strict_double
from selfmend.operators.quality import OK, RAGGED
from selfmend.sources.layouts import LAYOUT, LINE, SOURCE, STATUS, Layout, columns_of, distinct_layouts, rows_of

SEP = ","


def scan_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line (``value``) of the files under ``path``, in any
    sub-folder; a UTF-8 BOM is dropped by the reader."""
    return spark.read.option("recursiveFileLookup", "true").text(path)


def scan_lines(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """``value, source_path``: the lines of the files in any charset the
    session takes. Other charsets than UTF-8 go through the CSV reader, which
    decodes line by line; no line holds its separator."""
    if encoding.upper() == "UTF-8":
        lines = scan_text(spark, path)
    else:
        check_charset(spark, encoding)
        lines = (spark.read.schema("value string").option("recursiveFileLookup", "true").option("encoding", encoding)
                 .option("sep", "\u0001").option("quote", "").option("escape", "").csv(path))
    return lines.select("value", source_file_path().alias("source_path"))


def split_fields(lines: DataFrame, sep: str = SEP) -> DataFrame:
    """``fields`` = the line split on every ``sep``; trailing blanks kept."""
    return lines.select(F.split(F.col("value"), sep, -1).alias("fields"))


def header_names(spark: SparkSession, path: str | Sequence[str], sep: str = SEP) -> list[str]:
    """S3: the header = first line of a file.

    Only rows from a split that starts at offset 0 qualify, so the line taken
    is a file's first line however the files were packed into partitions. One
    line reaches the driver.
    """
    first = (scan_text(spark, path)
             .where(F.col("_metadata.file_block_start") == 0)
             .limit(1).collect())
    if not first:
        return []
    return first[0]["value"].lstrip("﻿").split(sep)


def file_headers(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """S3 for every file, ``path, line``: its first non-empty line, by a
    partial aggregate (a file's first split is read by one task, in line
    order). The table stays distributed. Files without a line are left out."""
    line = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    lines = (scan_text(spark, path).where((F.col("_metadata.file_block_start") == 0) & (F.col("value") != ""))
             .select(source_file_path().alias("path"), line.alias("line"), F.monotonically_increasing_id().alias("at")))
    first = lines.groupBy("path").agg(F.min_by("line", "at").alias("line"))
    return first.select("path", F.ltrim("line", F.lit("\ufeff")).alias("line"))


def headers_by_file(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> dict[str, str]:
    """``file_headers`` on the driver, for callers that hold the paths there
    anyway (a micro-batch, whose number of files is bounded)."""
    return {r["path"]: r["line"] for r in file_headers(spark, path, encoding).collect()}


def drop_repeated_headers(fields: DataFrame, header: Sequence[str]) -> DataFrame:
    """Drop every line whose first field equals the header's first field
    (so the headers of concatenated files go too)."""
    return fields.where(F.col("fields")[0] != F.lit(header[0]))


def all_string_table(fields: DataFrame, header: Sequence[str]) -> DataFrame:
    """Header-named, all-string table of well-formed rows. (Of a short row
    the missing trailing fields would be ``''``.)"""
    return fields.select(*[F.coalesce(F.get(F.col("fields"), i), F.lit("")).alias(name)
                           for i, name in enumerate(header)])


def typed_table(table: DataFrame, numeric: Iterable[str]) -> DataFrame:
    """Numeric columns -> double (strict parse, bad text -> NULL), rest string."""
    numeric = set(numeric)
    types = dict(table.dtypes)
    return table.select(*[strict_double(F.col(c)).alias(c) if c in numeric
                          else (F.col(c) if types[c] == "string" else F.col(c).cast("string")).alias(c)
                          for c in table.columns])


def positional_cast(fields: DataFrame, header: Sequence[str],
                    positions: Iterable[int]) -> DataFrame:
    """Fields at ``positions`` -> double, the rest string, named by header.
    Non-numeric text becomes NULL instead of failing the job."""
    positions = set(positions)
    cols = []
    for i, name in enumerate(header):
        f = F.coalesce(F.get(F.col("fields"), i), F.lit(""))
        cols.append((strict_double(f) if i in positions else f).alias(name))
    return fields.select(*cols)


def contract_schema(id_col: str | None, numeric: Sequence[str],
                    categorical: Sequence[str]) -> StructType:
    """The checked-table contract: id string, numerics double, categoricals string."""
    fields = [StructField(id_col, StringType(), True)] if id_col else []
    fields += [StructField(c, DoubleType(), True) for c in numeric]
    fields += [StructField(c, StringType(), True) for c in categorical]
    return StructType(fields)


def landed_rows(spark: SparkSession, path: str | Sequence[str], header: Sequence[str] | None = None,
                sep: str = SEP, encoding: str = "UTF-8") -> tuple[DataFrame, dict[str, Column]] | None:
    """Every line of the files under ``path`` as a row of its file's layout
    (``layouts.rows_of``), and all columns of all layouts over those rows. One
    scan; None if no file has a line.

    Only distinct headers reach the driver. If all files share one, nothing is
    looked up per file; else the table of files and layouts, which stays
    distributed, is joined to the lines by path."""
    if header is not None:
        layouts, headers = [Layout(sep.join(header), sep)], None
    else:
        headers = file_headers(spark, path, encoding)
        layouts = distinct_layouts(headers, sep)
    if not layouts:
        return None
    lines = scan_lines(spark, path, encoding).select(F.col("value").alias(LINE), F.col("source_path").alias(SOURCE))
    if len(layouts) == 1:
        lines = lines.withColumn(LAYOUT, F.lit(0))
    else:
        number = F.array_position(F.array(*[F.lit(x.line) for x in layouts]), F.col("line")) - 1
        lines = lines.join(headers.select(F.col("path").alias(SOURCE), number.cast("int").alias(LAYOUT)), SOURCE)
    return rows_of(lines, layouts), columns_of(layouts)


def read_delimited(spark: SparkSession, path: str | Sequence[str],
                   header: Sequence[str] | None = None, sep: str = SEP) -> DataFrame:
    """S1+S2+S3+S4+S5: the whole text path to an all-string table.

    Every file is read by its own header and columns are matched by name; a
    column that some files lack is ``''`` there, a name that a header repeats
    becomes ``x_2``. Rows with too few or too many fields are not in the
    table: ``read_ragged`` returns them. With ``header`` given, all files are
    taken to have it (no job to read headers)."""
    landed = landed_rows(spark, path, header, sep)
    if landed is None:
        return spark.createDataFrame([], StructType([]))
    rows, columns = landed
    return rows.where(F.col(STATUS) == OK).select(*[F.coalesce(c, F.lit("")).alias(name) for name, c in columns.items()])


def read_ragged(spark: SparkSession, path: str | Sequence[str],
                header: Sequence[str] | None = None, sep: str = SEP) -> DataFrame:
    """The rows ``read_delimited`` leaves out: ``value`` (the line),
    ``source_path`` and ``status``."""
    landed = landed_rows(spark, path, header, sep)
    if landed is None:
        return spark.createDataFrame([], "value string, source_path string, status int")
    return landed[0].where(F.col(STATUS) != OK).select(
        F.col(LINE).alias("value"), F.col(SOURCE).alias("source_path"), F.col(STATUS).alias("status"))


# Charsets Spark's readers accept without the JDK-charset switch.
STANDARD_CHARSETS = {"iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32", "utf-8"}


def check_charset(spark: SparkSession, encoding: str) -> None:
    """Readers take only Unicode/Latin-1 charsets by default; GBK (or another
    JDK charset) needs a session with ``spark.sql.legacy.javaCharsets``, as
    ``build_session`` makes it. A read does not change the session."""
    if encoding.lower() not in STANDARD_CHARSETS and \
            spark.conf.get("spark.sql.legacy.javaCharsets", "false").lower() != "true":
        raise ValueError(f"{encoding} needs a session with spark.sql.legacy.javaCharsets=true")


def read_csv_strings(spark: SparkSession, path: str | Sequence[str],
                     header: Sequence[str], sep: str = SEP,
                     with_source: bool = False, corrupt_column: str | None = None,
                     encoding: str = "UTF-8") -> DataFrame:
    """CSV reader with quoting off: every column string, blanks as ``''``.

    The header line of every file is skipped by the reader; columns are
    named by ``header`` (all files of one call must share it). With
    ``corrupt_column`` a row with too few or too many fields keeps its raw
    line in that column (NULL for well-formed rows).
    """
    fields = [StructField(c, StringType(), True) for c in header]
    if corrupt_column:
        fields.append(StructField(corrupt_column, StringType(), True))
    schema = StructType(fields)
    check_charset(spark, encoding)
    df = (spark.read.schema(schema)
          .option("header", True).option("sep", sep).option("encoding", encoding)
          .option("quote", "").option("escape", "")
          .option("mode", "PERMISSIVE").option("enforceSchema", True)
          .option("columnNameOfCorruptRecord", corrupt_column or "_corrupt_record")
          .csv(path))
    if with_source:
        df = df.withColumn("source_file", source_file_name())
    return df.na.fill("", list(header))


def csv_inferred(spark: SparkSession, path: str | Sequence[str],
                 encoding: str = "UTF-8", sep: str = SEP) -> DataFrame:
    """CSV with header and type inference (extra pass over the data;
    prefer an explicit schema in production)."""
    check_charset(spark, encoding)
    return (spark.read.option("header", True).option("inferSchema", True).option("recursiveFileLookup", "true")
            .option("encoding", encoding).option("sep", sep).csv(path))

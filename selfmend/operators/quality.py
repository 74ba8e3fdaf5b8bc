"""Data-quality operators (projection, validation, fill, batch status).

Everything is a column expression over one scan: the per-row validator that
the reference ran as a Python lambda is a single ``select``; the batch status
is one aggregate; the list of columns with bad values is one aggregate plus an
unpivot.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selfmend.functions.rules import RuleSet

# Status codes: of a file or batch, of a row (the wrong number of fields; a
# category outside the fitted vocabulary), of a file that cannot be read.
OK, EMPTY, MISSING_COLUMNS, RAGGED, UNSEEN, UNREADABLE = 0, 1, 2, 3, 4, 5


def project_required(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Id, numerics, categoricals -- fixed order."""
    return df.select(*[F.col(c) for c in rules.required])


def project_all_but(df: DataFrame, drop: Iterable[str], new: Sequence[Column] = ()) -> DataFrame:
    """Keep every column not in ``drop`` (original order), append ``new``."""
    drop = set(drop)
    return df.select(*[F.col(c) for c in df.columns if c not in drop], *new)


def missing_columns(columns: Iterable[str], rules: RuleSet) -> list[str]:
    """Required numeric/categorical columns absent from the input (schema only)."""
    have = set(columns)
    return [c for c in rules.numeric + rules.categorical if c not in have]


def batch_status(df: DataFrame, rules: RuleSet) -> DataFrame:
    """P4 (+P3): one row -- rows, columns, missing count, status.

    Status 1 = no rows or no columns, else 2 = required columns missing, else 0.
    The row count is a single partial/final aggregate (no data to the driver).
    """
    n_cols = len(df.columns)
    n_missing = len(missing_columns(df.columns, rules))
    rows = F.count(F.lit(1))
    status = (F.when((rows == 0) | F.lit(n_cols == 0), F.lit(EMPTY))
              .when(F.lit(n_missing > 0), F.lit(MISSING_COLUMNS))
              .otherwise(F.lit(OK)))
    return df.agg(rows.alias("n_rows"), F.lit(n_cols).alias("n_columns"),
                  F.lit(n_missing).alias("n_missing"), status.alias("status"))


def checked_columns(df: DataFrame, rules: RuleSet, extended: bool = False) -> list[Column]:
    """The validator's expressions: id passed through, then one per rule."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [F.col(rules.id)] if rules.id else []
    return cols + [r.checked(types.get(r.column)) for r in rules.active(extended)]


def validate(df: DataFrame, rules: RuleSet, extended: bool = False) -> DataFrame:
    """P7 (P5+P6 for every rule): row count kept, bad values -> NULL.
    With ``extended`` the unenforced catalogue entries are checked too (P10)."""
    return df.select(*checked_columns(df, rules, extended))


def fill_nulls(df: DataFrame, fill: Mapping[str, object]) -> DataFrame:
    """Fill NULL (and NaN in doubles) per column from ``fill``."""
    usable = {k: v for k, v in fill.items() if k in df.columns and v is not None}
    return df.na.fill(usable) if usable else df


def check_and_fill(df: DataFrame, rules: RuleSet, fill: Mapping[str, object]) -> DataFrame:
    """Project -> validate -> fill, lazily. Status comes from ``batch_status``."""
    return fill_nulls(validate(project_required(df, rules), rules), fill)


def batch_profile(df: DataFrame) -> DataFrame:
    """A1: row and column count of a batch, one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def exception_fields(df: DataFrame, rules: RuleSet, extended: bool = False) -> DataFrame:
    """Per rule column, how many values the check turned into NULL; only
    columns with at least one. One aggregate over one scan, then an unpivot of
    a single row."""
    types = {f.name: f.dataType for f in df.schema.fields}
    active = [r for r in rules.active(extended) if r.column in types]
    if not active:
        return df.sparkSession.createDataFrame([], "field string, n_bad long")
    counts = df.agg(*[F.count_if(r.checked(types[r.column]).isNull()).alias(f"c{i}")
                      for i, r in enumerate(active)])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(r.column).alias("field"), F.col(f"c{i}").alias("n_bad"))
        for i, r in enumerate(active)])).alias("s")).select("s.*")
    return stacked.where(F.col("n_bad") > 0)


def paren_to_underscore(name: str) -> str:
    """``X(Y)`` -> ``X_Y`` (names some older Parquet writers rejected)."""
    return re.sub(r"\((.*?)\)", r"_\1", name)


def rename_columns(df: DataFrame,
                   rename: Mapping[str, str] | Callable[[str], str] = paren_to_underscore) -> DataFrame:
    """Rename by mapping or by a name function (default ``X(Y)`` -> ``X_Y``)."""
    mapping = dict(rename) if isinstance(rename, Mapping) else {c: rename(c) for c in df.columns}
    mapping = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(mapping) if mapping else df


def blanks_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Blank (empty or whitespace) text -> NULL in the given string columns."""
    columns = set(columns)
    types = dict(df.dtypes)
    return df.select(*[F.when(F.trim(F.col(c)) != "", F.col(c)).alias(c)
                       if c in columns and types[c] == "string" else F.col(c)
                       for c in df.columns])

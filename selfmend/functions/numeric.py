"""Text -> number with the ticket semantics.

A field is a number when, after trimming blanks, it is a plain decimal
(optional sign, digits with an optional fraction, optional exponent). Blank
text, ``nan``, ``inf``, ``1d``, ``1_0`` and every other spelling become NULL
instead of failing the batch; NULL is later filled like any missing value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Plain decimal literal, the only text accepted as a number.
PLAIN_DECIMAL = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def strict_double(col: Column | str, dtype=None) -> Column:
    """Parse to double; anything that is not a plain decimal -> NULL.

    Numeric input columns (``dtype`` a NumericType) are cast directly and NaN
    becomes NULL, so the same rule applies to typed Parquet input.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, NumericType):
        v = c.cast("double")
        return F.when(~F.isnan(v), v)
    t = F.trim(c.cast("string"))
    return F.when(t.rlike(PLAIN_DECIMAL), t.try_cast("double"))


def parse_then(col: Column | str, dtype, keep) -> Column:
    """``strict_double`` fused with a predicate: the plain-decimal regex runs
    once per value and the parsed double is returned where ``keep(x)`` holds,
    else NULL. ``keep`` receives the parsed (non-NULL) value."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, NumericType):
        x = c.cast("double")
        return F.when(~F.isnan(x) & keep(x), x)
    t = F.trim(c.cast("string"))
    x = t.try_cast("double")
    return F.when(t.rlike(PLAIN_DECIMAL) & keep(x), x)


def fixed2_text(col: Column | str) -> Column:
    """Render a non-negative amount with exactly two decimals (``1234.5`` ->
    ``1234.50``) from integer cents, so every engine prints the same text."""
    c = F.col(col) if isinstance(col, str) else col
    cents = F.round(c * 100).cast("long")
    return F.concat(F.floor(cents / 100).cast("long").cast("string"), F.lit("."),
                    F.lpad((cents % 100).cast("string"), 2, "0"))

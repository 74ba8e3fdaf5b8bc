"""Declarative validation rules compiled to Column expressions.

A rule is data -- ``Range(col, lo, hi)``, ``OneOf(col, values)`` or
``Free(col)`` -- and compiles to a single expression that returns the cleaned
value or NULL. A whole rule set therefore becomes one ``select`` (no UDF, no
RDD hop), which Catalyst prunes, and ``isin`` lists become hash-set lookups.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from selfmend.functions.numeric import parse_then


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Range:
    """Numeric rule: blank, non-numeric, ``< lo`` or ``> hi`` -> NULL (bounds inclusive)."""

    column: str
    lo: float
    hi: float
    enforced: bool = True
    kind: str = field(default="numeric", init=False)

    def checked(self, dtype: DataType | None = None, source: Column | str | None = None) -> Column:
        src = _col(source if source is not None else self.column)
        return parse_then(src, dtype, lambda x: x.between(self.lo, self.hi)).alias(self.column)


@dataclass(frozen=True)
class OneOf:
    """Enumeration rule: blank or not in ``values`` -> NULL."""

    column: str
    values: tuple[str, ...]
    enforced: bool = True
    kind: str = field(default="categorical", init=False)

    def checked(self, dtype: DataType | None = None, source: Column | str | None = None) -> Column:
        c = _col(source if source is not None else self.column)
        if dtype is not None and not isinstance(dtype, StringType):
            c = c.cast("string")
        return F.when(c.isin(list(self.values)), c).alias(self.column)


@dataclass(frozen=True)
class Free:
    """Free-text entry: no domain; when enforced only blank -> NULL."""

    column: str
    enforced: bool = False
    kind: str = field(default="text", init=False)

    def checked(self, dtype: DataType | None = None, source: Column | str | None = None) -> Column:
        c = _col(source if source is not None else self.column).cast("string")
        return F.when(F.trim(c) != "", c).alias(self.column)


Rule = Range | OneOf | Free


@dataclass(frozen=True)
class RuleSet:
    """An id column (passed through unchecked) plus an ordered rule list.

    ``numeric`` and ``categorical`` are the enforced rules in catalogue order;
    they are the model's inputs. Unenforced rules are kept for the opt-in
    extended check.
    """

    rules: tuple[Rule, ...]
    id: str | None = None

    @property
    def numeric(self) -> tuple[str, ...]:
        return tuple(r.column for r in self.rules if r.enforced and r.kind == "numeric")

    @property
    def categorical(self) -> tuple[str, ...]:
        return tuple(r.column for r in self.rules if r.enforced and r.kind == "categorical")

    @property
    def required(self) -> tuple[str, ...]:
        """Required input columns in checked-table order: id, numerics, categoricals."""
        return ((self.id,) if self.id else ()) + self.numeric + self.categorical

    def rule(self, column: str) -> Rule:
        for r in self.rules:
            if r.column == column:
                return r
        raise KeyError(column)

    def active(self, extended: bool = False) -> list[Rule]:
        """Rules to apply, numerics first then categoricals (checked-table order);
        with ``extended`` the unenforced ones follow in catalogue order."""
        enforced = [self.rule(c) for c in self.numeric + self.categorical]
        if not extended:
            return enforced
        return enforced + [r for r in self.rules if not r.enforced]

"""Files of several layouts in one scan.

A layout is a header line. Each row is projected by the layout of its file:
the position of every column in every layout is a literal of the plan, so
files whose columns are permuted, missing or new are read together, by one
scan. What the plan holds grows with the number of layouts, not of files or
rows, and is bounded by ``MAX_LAYOUTS``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selfmend.operators.quality import OK, RAGGED

#: More distinct headers than this are an error: their positions are part of the plan.
MAX_LAYOUTS = 1000
#: Columns beside those of the files.
LAYOUT, STATUS, LINE, SOURCE, FIELDS = "__layout", "__status", "__line", "__source_path", "__fields"


def unique_names(header: Sequence[str]) -> tuple[list[str], list[str]]:
    """Header names made unique (a repeated ``x`` becomes ``x_2``, ``x_3``,
    ...) and the names that were repeated."""
    taken, names, repeated = set(header), [], []
    count: dict[str, int] = defaultdict(int)
    for h in header:
        count[h] += 1
        name, k = h, count[h]
        if k > 1:
            repeated.append(h)
            while f"{h}_{k}" in taken:
                k += 1
            name = f"{h}_{k}"
            taken.add(name)
        names.append(name)
    return names, sorted(set(repeated))


@dataclass(frozen=True)
class Layout:
    """A header line, its names made unique, and those that it repeats."""
    line: str
    sep: str = ","
    names: list[str] = field(init=False)
    repeated: list[str] = field(init=False)

    def __post_init__(self) -> None:
        names, repeated = unique_names(self.line.split(self.sep))
        object.__setattr__(self, "names", names)
        object.__setattr__(self, "repeated", repeated)

    @property
    def first(self) -> str:
        """The first field as it stands in the file: a line that starts with it is a header."""
        return self.line.split(self.sep)[0]


def distinct_layouts(headers: DataFrame, sep: str = ",") -> list[Layout]:
    """The layouts of ``headers`` (``path, line``), in order of their lines.
    Only distinct lines reach the driver."""
    lines = [r["line"] for r in headers.select("line").distinct().limit(MAX_LAYOUTS + 1).collect()]
    if len(lines) > MAX_LAYOUTS:
        raise ValueError(f"more than {MAX_LAYOUTS} different header lines")
    return [Layout(line, sep) for line in sorted(lines)]


def by_path(path: Column, files: Mapping[int, Sequence[str]]) -> Column:
    """The layout of a row by the path of its file: a hash lookup per layout."""
    out = None
    for layout, paths in sorted(files.items()):
        own = path.isin(list(paths))
        out = F.when(own, F.lit(layout)) if out is None else out.when(own, F.lit(layout))
    return F.lit(None).cast("int") if out is None else out


def _of(values: Sequence, layout: Column) -> Column:
    """The value that belongs to the row's layout."""
    if len(set(values)) == 1:
        return F.lit(values[0])
    return F.get(F.array(*[F.lit(v) for v in values]), layout)


def columns_of(layouts: Sequence[Layout]) -> dict[str, Column]:
    """All columns, in the order in which layouts bring them, as expressions
    over ``rows_of``: strings, NULL where the row's layout lacks the column.

    Filter rows before these are selected: a plan that filters on what was
    computed from columns aliased below it makes the optimizer try each of
    them with and without its alias."""
    names = dict.fromkeys(name for layout in layouts for name in layout.names)
    return {name: F.get(FIELDS, _of([x.names.index(name) if name in x.names else -1 for x in layouts], F.col(LAYOUT))) for name in names}


def rows_of(lines: DataFrame, layouts: Sequence[Layout], keep: Sequence[str] = (SOURCE,)) -> DataFrame:
    """``lines`` (``LINE``, ``LAYOUT`` and the columns ``keep``) split into
    ``FIELDS``, with ``STATUS``: ``OK`` or ``RAGGED`` (more or fewer fields than
    the header has names). Header lines inside a file and empty lines are no rows."""
    layout = F.col(LAYOUT)
    at_hand = lines.where((F.col(LINE) != "") & (F.substring_index(LINE, layouts[0].sep, 1) != _of([x.first for x in layouts], layout)))
    split = at_hand.select(*keep, LAYOUT, LINE, F.split(F.col(LINE), layouts[0].sep, -1).alias(FIELDS))
    size = _of([len(x.names) for x in layouts], layout)
    return split.withColumn(STATUS, F.when(F.size(FIELDS) == size, F.lit(OK)).otherwise(F.lit(RAGGED)))

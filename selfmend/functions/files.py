"""Source-file lineage from the scan's hidden ``_metadata`` column.

``_metadata.file_path`` and ``file_name`` are URI-encoded (a space is
``%20``, ``%`` is ``%25``); these helpers decode them to the names the file
system and the file stream use. URI path encoding leaves ``+`` alone, so it
is protected from ``url_decode`` (which would read it as a space).
"""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _decoded(c: Column) -> Column:
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def literal_path(path: str) -> str:
    """A path passed to a reader as itself: glob characters escaped, so a
    file named ``a[1].csv`` or ``b{2}.csv`` is read, not pattern-matched."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def source_file_path() -> Column:
    """Full path of the file a row was read from, as the file stream reports it."""
    return _decoded(F.col("_metadata.file_path"))


def source_file_name() -> Column:
    """Last path segment of the file a row was read from."""
    return _decoded(F.col("_metadata.file_name"))

"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import io
import os
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from selfmend.session import scratch_path

#: Texts are handed to numpy in slices of about this many bytes.
SLICE_BYTES = 1_500_000
#: And at most this many rows, whatever the session's batch size: users number the rows of a slice in 16 bits.
SLICE_ROWS = 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts the
    lineage, survives lost executors, and gives the planner a known size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application,
    by way of the shared scratch folder: they need not have it on their path,
    or start in its folder."""
    context = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if context.applicationId in _shipped or not os.path.isdir(root):
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    path = context._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'code')}/selfmend.zip")
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    out = files.create(path)
    out.write(bytearray(data.getvalue()))
    out.close()
    context.addPyFile(files.makeQualified(path).toString())
    _shipped.add(context.applicationId)


def release_memory() -> None:
    """Hand what this process has freed back to the system. Python workers are
    used again by later stages, which otherwise start with what earlier ones
    left allocated."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):       # another C library: nothing to do
        pass


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers, which give
    their memory back at the end of each task."""
    ship_package(df.sparkSession)

    def run(batches):
        yield from function(batches)
        release_memory()

    return df.mapInArrow(run, schema)


def text_column(spark: SparkSession, function: Callable[[pa.RecordBatch], pa.Array], kind: str, *text: Column) -> Column:
    """A column computed from a text column, in slices of bounded size (given
    to ``function`` as a batch with the column ``text``). Only the text goes to
    the Python workers and only the result comes back; the other columns of
    the rows stay where they are."""
    ship_package(spark)

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            batch = pa.RecordBatch.from_arrays([column], names=["text"])
            found = [function(part) for part in text_slices(iter([batch]))]
            yield pa.concat_arrays(found) if found else function(batch)
        release_memory()

    return run(*text)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of the Arrow batches with about ``limit`` bytes of text each
    (at least one row, so one very long text is a slice of its own) and at
    most ``SLICE_ROWS`` rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        before = np.cumsum(sizes, dtype=np.int64) - sizes
        cuts = np.flatnonzero(np.diff(before // limit) | np.diff(np.arange(batch.num_rows) // SLICE_ROWS)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            yield batch.slice(a, b - a)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def with_text(docs: DataFrame, text) -> DataFrame:
    """``docs`` with its text replaced and, where it has one, ``n_chars`` too."""
    out = docs.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without copying, and the rows' edges in
    them (one more than rows). NULLs are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    offset_type = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, dtype=offset_type)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and len(data) else np.zeros(0, dtype=np.uint8)
    return buf[edges[0]:edges[-1]], edges - edges[0]


def runs(inside: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of true bytes; runs stop at row edges."""
    n = len(inside)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    after = np.zeros(n, dtype=bool)                 # the byte before is in the same run
    after[1:] = inside[:-1]
    after[edges[:-1][edges[:-1] < n]] = False
    first = inside & ~after
    last = inside.copy()
    last[:-1] &= ~(inside[1:] & after[1:])
    return np.flatnonzero(first), np.flatnonzero(last) + 1


_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE ** i`` and ``_BASE ** -i`` modulo 2**64, for i below n."""
    size = max(_CHUNK, n)
    if size not in _powers:
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            out.append(np.cumprod(x, dtype=np.uint64))
        _powers.clear()
        _powers[size] = tuple(out)
    return _powers[size]


def run_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run, by a polynomial over prefix
    sums: equal runs hash alike wherever they stand."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        # the runs that end within a chunk of bytes; one longer run is a chunk of its own
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + _CHUNK, side="right")))
        part = buf[base:ends[j - 1]]
        power, inverse = _power_tables(len(part))
        sums = np.empty(len(part) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_VALUE[part] * power[:len(part)], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[b] - sums[a]) * inverse[a]
        i = j
    return mix64(out + (ends - starts).astype(np.uint64))

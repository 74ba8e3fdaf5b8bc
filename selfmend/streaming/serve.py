"""Score ticket files as they land.

The reference polled a folder every 10 s, scored each file on its own and
moved it away. Here:

* S9  a ``binaryFile`` stream over the landing folder selects only ``path``
      and ``length`` (file contents are never read by the stream itself);
      progress lives in the checkpoint, so a restarted job resumes where it
      stopped and a lost executor only re-runs its tasks;
* T1  ``foreachBatch`` gets the new paths (file names only reach the driver),
      finds all header lines in one job and reads all files with **one** scan,
      whatever their layouts: each row is projected by the layout of its file
      (``sources.layouts``). Header lines inside a file are no rows (S4). One
      write takes the scored rows, and only if there are any others a second
      one takes those; nothing is cached. A file that cannot be read any more
      gets status 5 and does not hold up the others;
* P4/P3 per file: no data rows -> status 1, required column missing ->
      status 2 (its rows are quarantined, T5); a row with too few or too many
      fields is quarantined with status 3, a row with a category outside the
      fitted vocabulary (``handle_invalid='error'``) with status 4; the
      file's other rows are scored;
* T2  the fitted model and fill values are closed over by the batch function,
      or taken from a folder of versions, the newest for each new batch;
* T4  one metrics row per file (batch id, file, rows, status, seconds), from
      what the write itself observed (A1); scored and quarantined rows keep
      ``source_path``, so files of the same name in different sub-folders stay
      apart;
* T3  ``cleanSource=archive`` moves processed files to an archive folder;
      input is never deleted.

A batch becomes visible at once: its outputs are written to hidden staging
folders, moved to ``batch_id=N`` when all are complete, and listed by a commit
(``commits``). A batch that is run again replaces what it left before, and
keeps the model version that it was first given.
"""

from __future__ import annotations

import time
import zlib
from collections import Counter, defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, LongType, StringType, StructField, StructType,
                               TimestampType)

from selfmend.functions.files import literal_path
from selfmend.operators import quality, sinks
from selfmend.operators.quality import MISSING_COLUMNS, OK, RAGGED, UNREADABLE, UNSEEN
from selfmend.plans.scoring import Fitted, ScoringSpec, score, unseen
from selfmend.sources.delimited import headers_by_file, scan_lines
from selfmend.sources.layouts import LAYOUT, LINE, SOURCE, STATUS, Layout, by_path, columns_of, rows_of, unique_names
from selfmend.streaming import commits, versions

__all__ = ["ServeConfig", "landing_stream", "process_batch", "serve", "unique_names"]

BINARY_FILE_SCHEMA = StructType([
    StructField("path", StringType(), False),
    StructField("modificationTime", TimestampType(), False),
    StructField("length", LongType(), False),
    StructField("content", BinaryType(), True),
])

METRICS_SCHEMA = ("source_file string, source_path string, n_rows long, n_ragged long, n_unseen long, "
                  "status int, missing string, elapsed_s double")
LANDED_LINE = "landed_line"        # of a ragged row, as it stood in the file
PROBES = 32         # files opened at a time to find those that cannot be read
REASONS = {MISSING_COLUMNS: "missing_columns", RAGGED: "ragged", UNSEEN: "unseen_category"}
#: What is observed of a row: its file and one of so many codes, a status or this one.
CODES, RAGGED_AND_MISSING = 8, 6


@dataclass(frozen=True)
class ServeConfig:
    landing: str
    output: str
    quarantine: str
    metrics: str
    checkpoint: str
    glob: str = "*.csv"
    archive_dir: str | None = None
    max_files_per_trigger: int = 1000            # bounds one micro-batch, and the paths the driver gets
    processing_time: str | None = "10 seconds"   # None -> availableNow (drain and stop)
    output_format: str = "json"
    encoding: str = "UTF-8"                      # landing files' charset (e.g. GBK)
    models: str | None = None                    # folder of model versions, looked at per micro-batch

    def __post_init__(self) -> None:
        if not self.max_files_per_trigger or self.max_files_per_trigger < 1:
            raise ValueError("max_files_per_trigger must be positive: a batch's paths reach the driver")


def landing_stream(spark: SparkSession, landing: str, glob: str = "*.csv",
                   max_files_per_trigger: int = 1000,
                   archive_dir: str | None = None) -> DataFrame:
    """New files under ``landing`` (recursive) whose name matches ``glob``."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(landing).select("path", "length")


def _can_open(spark: SparkSession, path: str) -> bool:
    """Whether a file can be opened and its first byte read."""
    jvm = spark.sparkContext._jvm
    try:
        p = jvm.org.apache.hadoop.fs.Path(path)
        stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
        try:
            stream.read()
        finally:
            stream.close()
        return True
    except Exception:  # noqa: BLE001  whatever the file system reports, the file is unreadable
        return False


def read_headers(spark: SparkSession, paths: list[str], encoding: str) -> tuple[dict[str, str], list[str]]:
    """The header line of each file ('' if it has none), and the files that
    cannot be read. One job; only when it fails are the files tried one by one."""
    def headers(files):
        found = headers_by_file(spark, [literal_path(p) for p in files], encoding) if files else {}
        return {p: found.get(p, "") for p in files}

    try:
        return headers(paths), []
    except Exception:  # noqa: BLE001  one bad file fails the whole job
        with ThreadPoolExecutor(max_workers=min(PROBES, len(paths))) as pool:
            readable = list(pool.map(lambda p: _can_open(spark, p), paths))
        if all(readable):
            raise
        return (headers([p for p, ok in zip(paths, readable) if ok]),
                [p for p, ok in zip(paths, readable) if not ok])


def _file_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


@dataclass(frozen=True)
class Landed:
    """The files of a micro-batch that have a line, by layout."""
    layouts: list[Layout]
    missing: list[list[str]]        # of each layout: required columns it lacks, or has twice
    files: dict[str, int]           # each file's layout

    @staticmethod
    def of(headers: dict[str, str], spec: ScoringSpec) -> Landed:
        lines = sorted({line for line in headers.values() if line})
        layouts = [Layout(line) for line in lines]
        required = set(spec.rules.numeric + spec.rules.categorical)
        missing = [quality.missing_columns(x.names, spec.rules) + [c for c in x.repeated if c in required] for x in layouts]
        return Landed(layouts, missing, {p: lines.index(line) for p, line in headers.items() if line})

    def rows(self, spark: SparkSession, spec: ScoringSpec, fitted: Fitted, encoding: str) -> DataFrame:
        """Their rows, from one scan, with the status that decides where each goes."""
        files = defaultdict(list)
        for p, layout in self.files.items():
            files[layout].append(p)
        lines = scan_lines(spark, [literal_path(p) for p in self.files], encoding)
        lines = lines.select(F.col("value").alias(LINE), F.col("source_path").alias(SOURCE)) \
            .withColumn(LAYOUT, by_path(F.col(SOURCE), files))
        rows = rows_of(lines, self.layouts)
        columns = columns_of(self.layouts)
        short = F.lit(False)
        if any(self.missing):
            short = F.col(LAYOUT).isin([i for i, m in enumerate(self.missing) if m])
        new = F.lit(False)
        if self.complete and spec.handle_invalid == "error":
            new = unseen(columns, spec, fitted)
        ragged = F.col(STATUS) == RAGGED
        status = (F.when(short, F.when(ragged, F.lit(RAGGED_AND_MISSING)).otherwise(F.lit(MISSING_COLUMNS)))
                  .when(ragged, F.lit(RAGGED)).when(new, F.lit(UNSEEN)).otherwise(F.lit(OK)))
        return rows.withColumn(STATUS, status)

    @property
    def complete(self) -> bool:
        """Whether any layout has all that scoring needs."""
        return not all(self.missing)


class FileCounts:
    """Rows per file and status, observed while the rows are written. A file is
    named by a 32-bit checksum of its path, salted until all differ; the counts
    are those of a histogram with a bin for every (file, status), hence exact
    (its bins' places are averages, off by rounding)."""

    def __init__(self, paths: list[str]) -> None:
        self.paths, self.salt = paths, 0
        while len(set(self._names().values())) < len(paths):
            self.salt += 1
        self.observation = Observation()

    def _names(self) -> dict[str, int]:
        return {p: zlib.crc32(f"{self.salt}{p}".encode()) for p in self.paths}

    def observe(self, rows: DataFrame) -> DataFrame:
        name = F.crc32(F.concat(F.lit(str(self.salt)), F.col(SOURCE)).cast("binary"))
        code = (name * CODES + F.col(STATUS)).cast("double")
        return rows.observe(self.observation, F.histogram_numeric(code, F.lit(CODES * len(self.paths))).alias("n"))

    def get(self) -> dict[str, Counter]:
        by_name: dict[int, Counter] = defaultdict(Counter)
        for r in self.observation.get["n"] or []:
            name, status = divmod(round(r["x"]), CODES)
            by_name[name][status] += round(r["y"])
        return {p: by_name[name] for p, name in self._names().items()}


def _named(rows: DataFrame, layouts: list[Layout], *more: Column) -> DataFrame:
    """The files' columns, with the file's path and name."""
    return rows.select(*[c.alias(name) for name, c in columns_of(layouts).items()], F.col(SOURCE).alias("source_path"),
                       F.regexp_extract(SOURCE, r"([^/]+)$", 1).alias("source_file"), *more)


def process_batch(spark: SparkSession, batch: DataFrame, batch_id: int, spec: ScoringSpec,
                  fitted: Fitted | None, cfg: ServeConfig) -> None:
    """T1's body for one micro-batch."""
    started = time.time()
    paths = [r["path"] for r in batch.select("path").collect()]
    if not paths:
        return
    version = None
    if cfg.models:
        version, fitted = versions.of_batch(spark, cfg.models, cfg.checkpoint, batch_id)
    headers, unreadable = read_headers(spark, paths, cfg.encoding)
    landed = Landed.of(headers, spec)
    with commits.Batch(spark, batch_id, cfg.output) as out:
        counts = _write(spark, landed, spec, fitted, version, cfg, out) if landed.files else {}
        metrics = [(_file_name(p), p, 0, 0, 0, UNREADABLE, "", 0.0) for p in unreadable]
        for p in headers:
            n = counts.get(p, Counter())
            missing = landed.missing[landed.files[p]] if p in landed.files else []
            rows = sum(n.values())
            status = quality.EMPTY if not rows else (MISSING_COLUMNS if missing else OK)
            metrics.append((_file_name(p), p, rows, n[RAGGED] + n[RAGGED_AND_MISSING], n[UNSEEN], status, ",".join(missing), 0.0))
        elapsed = time.time() - started
        table = spark.createDataFrame([m[:-1] + (elapsed,) for m in metrics], METRICS_SCHEMA).coalesce(1)
        table.write.mode("overwrite").parquet(out.staged(cfg.metrics))
        out.commit({"model_version": version, "n_files": len(paths)})


def _write(spark, landed: Landed, spec, fitted, version, cfg, out) -> dict[str, Counter]:
    """Score and write the rows that can be, set the others aside; the counts per file."""
    counts = FileCounts(list(landed.files))
    rows = landed.rows(spark, spec, fitted, cfg.encoding)
    observed = counts.observe(rows)
    if landed.complete:
        result = score(_named(observed.where(F.col(STATUS) == OK), landed.layouts), spec, fitted)
        if version is not None:
            result = result.withColumn("model_version", F.lit(version))
        writer = {"csv": sinks.write_csv_header, "parquet": sinks.write_parquet}.get(cfg.output_format, sinks.write_json)
        writer(result, out.staged(cfg.output), partition_by="source_file")
        if not sum(n[OK] for n in counts.get().values()):
            out.forget(cfg.output)
    if not landed.complete or any(n[s] for n in counts.get().values() for s in (*REASONS, RAGGED_AND_MISSING)):
        aside = (rows if landed.complete else observed).where(F.col(STATUS) != OK)
        status = F.when(F.col(STATUS) == RAGGED_AND_MISSING, F.lit(MISSING_COLUMNS)).otherwise(F.col(STATUS))
        reason = F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])[status]
        aside = _named(aside, landed.layouts, status.alias("status"), F.when(status == RAGGED, F.col(LINE)).alias(LANDED_LINE),
                       reason.alias("reason"))
        sinks.write_json(aside, out.staged(cfg.quarantine), partition_by=["reason", "source_file"])
        if not sum(sum(n.values()) for n in counts.get().values()):
            out.forget(cfg.quarantine)
    return counts.get()


def serve(spark: SparkSession, spec: ScoringSpec, fitted: Fitted | None, cfg: ServeConfig):
    """Start the streaming job; returns the ``StreamingQuery``.

    ``processing_time=None`` drains what has landed and stops
    (``availableNow``), else it polls on that interval like the reference.
    With ``cfg.models`` the model comes from that folder and ``fitted`` is not used.
    """
    stream = landing_stream(spark, cfg.landing, cfg.glob, cfg.max_files_per_trigger, cfg.archive_dir)
    writer = (stream.writeStream.option("checkpointLocation", cfg.checkpoint)
              .foreachBatch(lambda b, i: process_batch(spark, b, i, spec, fitted, cfg)))
    writer = (writer.trigger(availableNow=True) if cfg.processing_time is None
              else writer.trigger(processingTime=cfg.processing_time))
    return writer.start()

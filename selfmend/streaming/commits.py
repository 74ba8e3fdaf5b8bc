"""Micro-batches that become visible at once.

Each output of a batch is written to a staging folder inside its target; names
with a leading underscore are hidden from Spark's readers. ``commit`` moves
them to ``batch_id=N``, replacing what an earlier run of the same batch left
there, and last writes the batch's commit, one small file replaced by a rename.
A run that ends before leaves nothing that a reader sees; the next run of the
batch writes the staging folders anew.

A reader of several outputs, or on a store whose renames copy, goes by the
commits: ``committed`` reads only batches that have one.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGING, COMMITS = "_staging", "_commits"
COMMIT_SCHEMA = "batch_id long, outputs array<string>, model_version string, n_files long"


def file_system(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """One small file, whole or not at all: written beside, then renamed over."""
    jvm = spark.sparkContext._jvm
    target, files = file_system(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.tmp")
    files.mkdirs(target.getParent())
    out = files.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(beside), files.makeQualified(target), options)


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    p, files = file_system(spark, path)
    if not files.exists(p):
        return None
    stream = files.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


class Batch:
    """The outputs of one micro-batch. ``owner`` is the folder that holds its commit."""

    def __init__(self, spark: SparkSession, batch_id: int, owner: str) -> None:
        self.spark, self.batch_id, self.owner = spark, batch_id, owner
        self.targets: list[str] = []
        self.seen: list[str] = []

    def __enter__(self) -> Batch:
        return self

    def __exit__(self, *_) -> None:
        for target in self.seen:
            self._delete(f"{target}/{STAGING}/batch_id={self.batch_id}")

    def _delete(self, path: str) -> None:
        p, files = file_system(self.spark, path)
        files.delete(p, True)

    def staged(self, target: str) -> str:
        """The folder to write an output to, empty at first."""
        if target not in self.targets:
            self.targets.append(target)
            self.seen.append(target)
        path = f"{target}/{STAGING}/batch_id={self.batch_id}"
        self._delete(path)
        return path

    def forget(self, target: str) -> None:
        """The output holds no row after all."""
        self.targets.remove(target)

    def commit(self, facts: dict) -> None:
        earlier = json.loads(read_small(self.spark, self._commit) or "{}").get("outputs", [])
        for target in dict.fromkeys([*earlier, *self.seen]):
            final = f"{target}/batch_id={self.batch_id}"
            self._delete(final)
            if target in self.targets:
                source, files = file_system(self.spark, f"{target}/{STAGING}/batch_id={self.batch_id}")
                if not files.rename(source, file_system(self.spark, final)[0]):
                    raise OSError(f"could not move {source.toString()} to {final}")
        write_small(self.spark, self._commit, json.dumps({"batch_id": self.batch_id, "outputs": self.targets, **facts}))

    @property
    def _commit(self) -> str:
        return f"{self.owner}/{COMMITS}/{self.batch_id}.json"


def committed_batches(spark: SparkSession, owner: str) -> DataFrame:
    """The commits: ``batch_id, outputs, model_version, n_files``."""
    path, files = file_system(spark, f"{owner}/{COMMITS}")
    if not files.exists(path):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return spark.read.schema(COMMIT_SCHEMA).json(f"{owner}/{COMMITS}")


def committed(spark: SparkSession, owner: str, rows: DataFrame) -> DataFrame:
    """Those ``rows`` of an output (with its ``batch_id``) whose batch is committed."""
    own = committed_batches(spark, owner).select(F.col("batch_id").cast(rows.schema["batch_id"].dataType).alias("batch_id"))
    return rows.join(own, "batch_id", "left_semi")

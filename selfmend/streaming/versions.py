"""Model versions that a running stream takes up.

A folder holds one saved model per version, ``version=<name>``. ``publish``
saves a new one aside and moves it in by one rename, so a version is there as
a whole or not at all. Each new micro-batch takes the greatest version (by
number where names are numbers) and notes it in the checkpoint folder before
anything is scored: a batch that is run again, after a restart too, is scored
by the same version.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from selfmend.plans.scoring import Fitted
from selfmend.streaming.commits import STAGING, file_system, read_small, write_small

_loaded: dict[tuple[str, str, str], Fitted] = {}


def publish(spark: SparkSession, fitted: Fitted, models: str, version: str) -> None:
    """Add a version. Names are given once."""
    if version in available(spark, models):
        raise ValueError(f"version {version} is there already")
    fitted.save(spark, f"{models}/{STAGING}/{version}")
    source, files = file_system(spark, f"{models}/{STAGING}/{version}")
    if not files.rename(source, file_system(spark, f"{models}/version={version}")[0]):
        raise OSError(f"could not move version {version} into {models}")


def _order(name: str) -> tuple:
    return (0, int(name), name) if name.isdecimal() else (1, 0, name)


def available(spark: SparkSession, models: str) -> list[str]:
    """The versions, oldest first: numbers by value, before other names."""
    path, files = file_system(spark, models)
    if not files.exists(path):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path)]
    return sorted((n.partition("=")[2] for n in names if n.startswith("version=")), key=_order)


def load(spark: SparkSession, models: str, version: str) -> Fitted:
    """A version, kept by the driver while it is the last one asked for."""
    key = (spark.sparkContext.applicationId, models, version)
    if key not in _loaded:
        fitted = Fitted.load(spark, f"{models}/version={version}")
        _loaded.clear()
        _loaded[key] = fitted
    return _loaded[key]


def of_batch(spark: SparkSession, models: str, checkpoint: str, batch_id: int) -> tuple[str, Fitted]:
    """The version that scores a batch, and its model."""
    note = f"{checkpoint}/model_versions/{batch_id}"
    version = read_small(spark, note)
    if version is None:
        found = available(spark, models)
        if not found:
            raise ValueError(f"no model version in {models}")
        version = found[-1]
        write_small(spark, note, version)
    return version, load(spark, models, version)

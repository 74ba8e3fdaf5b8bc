"""Train and serve from the command line (``spark-submit`` or ``python -m``).

    python -m selfmend.job train --train IN --model M [--quarantine Q]
    python -m selfmend.job serve --model M --landing L --output O --metrics T
                                 --quarantine Q --checkpoint C [--archive A]
                                 [--once] [--poll SECONDS] [--encoding GBK]

``train`` reads labelled ticket files (each by its own header), sets rows
with the wrong number of fields aside under ``--quarantine`` and writes the
fitted pipeline. ``serve`` loads it and scores what lands until stopped, or,
with ``--once``, what has landed by now. Paths are any the cluster reads.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from selfmend.operators import sinks
from selfmend.plans import scoring, tickets
from selfmend.session import build_session
from selfmend.sources.delimited import read_delimited, read_ragged
from selfmend.streaming import ServeConfig, serve


def train(spark: SparkSession, path: str, model: str, quarantine: str | None = None,
          spec: scoring.ScoringSpec = tickets.SPEC) -> scoring.Fitted:
    """Fit on the files under ``path`` and save to ``model``. Ragged rows go to
    ``quarantine``; without one they are an error, so none is lost unseen."""
    ragged = read_ragged(spark, path)
    if quarantine:
        sinks.write_json(ragged, quarantine)
    else:
        bad = ragged.agg(F.count(F.lit(1)).alias("n"), F.min("source_path").alias("file")).first()
        if bad["n"]:
            raise ValueError(f"{bad['n']} rows with the wrong number of fields, e.g. in {bad['file']}; "
                             "give --quarantine to set them aside")
    fitted = scoring.fit(read_delimited(spark, path), spec)
    fitted.save(spark, model)
    return fitted


def start(spark: SparkSession, model: str, cfg: ServeConfig, spec: scoring.ScoringSpec = tickets.SPEC):
    """Load the model and start the stream; returns the ``StreamingQuery``."""
    return serve(spark, spec, scoring.Fitted.load(spark, model), cfg)


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="selfmend.job")
    parser.add_argument("--master")
    commands = parser.add_subparsers(dest="command", required=True)
    t = commands.add_parser("train")
    t.add_argument("--train", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--quarantine")
    s = commands.add_parser("serve")
    for name in ("model", "landing", "output", "metrics", "quarantine", "checkpoint"):
        s.add_argument(f"--{name}", required=True)
    s.add_argument("--archive")
    s.add_argument("--once", action="store_true")
    s.add_argument("--poll", type=int, default=10)
    s.add_argument("--encoding", default="UTF-8")
    a = parser.parse_args(args)
    spark = build_session(a.master, app=f"selfmend-{a.command}")
    if a.command == "train":
        train(spark, a.train, a.model, a.quarantine)
        return
    cfg = ServeConfig(landing=a.landing, output=a.output, quarantine=a.quarantine, metrics=a.metrics,
                      checkpoint=a.checkpoint, archive_dir=a.archive, encoding=a.encoding,
                      processing_time=None if a.once else f"{a.poll} seconds")
    start(spark, a.model, cfg).awaitTermination()


if __name__ == "__main__":
    main()

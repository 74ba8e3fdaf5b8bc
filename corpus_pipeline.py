"""The corpus pipeline over ``documents``: language ID, line dedup, near
dedup, secret masking, packing. Each stage is written as Parquet to the shared
scratch folder and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from selfmend.llm import icws, langid, packing, secret_scan, site_lines
from selfmend.llm.common import materialised, table
from selfmend.llm.queries import _tokenizer


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents without a determined language go."""
    return langid.keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: lines that stand on too many pages of their source go.
    Pages that would lose most of their words do not count: they are near
    copies, which the next stage settles."""
    return site_lines.drop_boilerplate(docs, "source", max_share=0.5)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one document of each class of near duplicates stays."""
    return icws.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: secrets are masked in the text; every document stays."""
    return secret_scan.mask_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: token pieces and their places in sequences."""
    return packing.pack(docs, _tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("line_dedup", lines),
    ("near_dedup", near_copies),
    ("secret_scan", secrets),
    ("packing", packed),
]

#: Model fitting, sampling and tokenisation have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

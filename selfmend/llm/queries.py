"""The queries ``opN_<name>``: each applies one operator, with production
parameters, to its whole table. ``ORACLE`` holds the DuckDB statements of
those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from selfmend.llm import (context_mixing, conversation_trie, hard_negatives, icws, langid, licences, line_quality,
                          packing, quotes, secret_scan, site_lines, sp_bpe, va_topk)
from selfmend.llm.common import table


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(table(spark, sf_dir, "conversations"))


def op2_site_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.report(table(spark, sf_dir, "documents"), "source")


def op3_va_file_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return sp_bpe.digests(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)


def op6_line_frequency_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.assess(table(spark, sf_dir, "documents"), "source")


def op7_icws_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return icws.near_duplicates(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = conversation_trie.sequences(table(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return conversation_trie.prefix_trie(conversation_trie.with_shared_heads(own, 100, head, 5))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quotation_linking": op1_quotation_linking,
    "op2_site_line_dedup": op2_site_line_dedup,
    "op3_va_file_topk": op3_va_file_topk,
    "op4_license_digests": op4_license_digests,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_line_frequency_quality": op6_line_frequency_quality,
    "op7_icws_near_dedup": op7_icws_near_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_language_id": op9_language_id,
    "op10_secret_scan": op10_secret_scan,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_context_mixing": op13_context_mixing,
}

ORACLE: dict[str, str] = {
    "op1_quotation_linking": quotes.ORACLE,
    "op2_site_line_dedup": site_lines.ORACLE,
    "op3_va_file_topk": va_topk.ORACLE,
    "op4_license_digests": licences.ORACLE,
    "op6_line_frequency_quality": line_quality.ORACLE,
    "op11_conversation_trie": conversation_trie.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}

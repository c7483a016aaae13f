"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm.exact_dedup import exact_dedup
from millwright.llm.line_dedup import line_dedup
from millwright.llm.mixing import words_taken
from millwright.llm.near_dedup import near_dedup
from millwright.llm.packing import pack_documents
from millwright.llm.prefix_trie import conversation_trie
from millwright.llm.quality import apply_policy, ledger
from millwright.llm.secret_scan import scan_secrets
from millwright.llm.suffix_dedup import repeated_passages
from millwright.llm.text import table
from millwright.llm.token_alignment import align_tokens
from millwright.llm.topk_search import top_scores
from millwright.llm.url_filter import judge_urls
from millwright.llm.warc import archived
from millwright.sources.scratch import discard, fresh_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words_taken(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger; base_failed is the policy of the two base rules, kept the current policy."""
    judged = apply_policy(ledger(table(spark, sf_dir, "documents")))
    base = apply_policy(judged.withColumnRenamed("kept", "by_policy"), "base")
    return base.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~F.col("kept")).alias("base_failed"), F.col("by_policy").alias("kept"), "failures")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, whose site is their source."""
    done = line_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "source", "n_lines", "n_removed", "text")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).drop("spans")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), largest=True)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    try:
        return archived(table(spark, sf_dir, "pages"), path)
    finally:
        discard(spark, path)  # what was read back of the archives is kept


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), VOCABULARY)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_MODEL)


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_scores(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_quality_rules, op3_line_dedup, op4_suffix_dedup, op5_near_dedup, op6_exact_dedup, op7_warc,
        op8_secret_scan, op9_packing, op10_url_filter, op11_conversation_trie, op12_token_alignment, op13_topk_search,
    )
}

"""The training-data pipeline: documents in, packed sequences out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm.line_dedup import line_dedup
from millwright.llm.mixing import mixed
from millwright.llm.near_dedup import without_near_copies
from millwright.llm.packing import pack_documents
from millwright.llm.quality import kept_documents
from millwright.llm.queries import VOCABULARY
from millwright.llm.text import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the current policy rejects."""
    return kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the boilerplate lines of their source; ``n_chars`` follows the text."""
    done = line_dedup(docs)
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        done = done.withColumn("n_chars", F.when(F.col("n_removed") > 0, n_chars).otherwise(F.col("n_chars")))
    return done.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies."""
    return without_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source at its share of the words, in whole passes and one partial pass."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return pack_documents(docs, VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near_copies),
    ("mix_sources", mixing), ("packing", packing),
]
#: Tokens and hashed sketches are not SQL's; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs

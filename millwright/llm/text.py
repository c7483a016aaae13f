"""What the operators of this package share: words, whole columns, scratch tables."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII blanks (the set of ``bytes.split``).
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, so its later tasks find it filled."""
    holder = sys.modules.setdefault("_millwright_llm_worker", types.ModuleType("_millwright_llm_worker"))
    return holder.__dict__.setdefault(name, {})


def release_memory() -> None:
    """Hand freed memory back to the system, where the platform can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` on a task's batches; a worker that then waits for its next task holds little."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            release_memory()

    return run

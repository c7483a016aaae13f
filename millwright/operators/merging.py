"""Bag union, whole-row distinct and the report on a merge.

Equality of rows is that of GROUP BY: NULL equals NULL, NaN equals NaN and
-0.0 equals 0.0.  Grouping combines equal rows inside each task before the
shuffle, so any number of copies of one row costs one row per task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.operators import bloom
from millwright.sources.scratch import materialize

BROADCAST_BYTES = 64 * 1024 * 1024
#: Bytes of a Bloom filter that may be broadcast, of some eight million rows.
FILTER_BYTES = 128 * 1024 * 1024

_IN_BASE = "__in_base"
_IN_BATCH = "__in_batch"


def union_all(base: DataFrame, batch: DataFrame) -> DataFrame:
    """Both tables, columns matched by name, absent columns NULL."""
    return base.unionByName(batch, allowMissingColumns=True)


def merge_distinct(base: DataFrame, batch: DataFrame) -> DataFrame:
    """The union without duplicate rows, whichever side they come from."""
    return union_all(base, batch).dropDuplicates()


def _counted(base: DataFrame, batch: DataFrame) -> DataFrame:
    """One row per distinct row with its copies on either side (one shuffle)."""
    tagged = union_all(
        base.withColumns({_IN_BASE: F.lit(1), _IN_BATCH: F.lit(0)}),
        batch.withColumns({_IN_BASE: F.lit(0), _IN_BATCH: F.lit(1)}),
    )
    keys = [F.col(f"`{c}`") for c in tagged.columns if c not in (_IN_BASE, _IN_BATCH)]
    return tagged.groupBy(*keys).agg(
        F.sum(_IN_BASE).alias(_IN_BASE), F.sum(_IN_BATCH).alias(_IN_BATCH)
    )


def duplicates_removed(base: DataFrame, batch: DataFrame) -> DataFrame:
    """One row: how many rows the merge drops."""
    copies = F.col(_IN_BASE) + F.col(_IN_BATCH)
    return _counted(base, batch).agg(
        F.coalesce(F.sum(copies - 1), F.lit(0)).alias("duplicates_removed")
    )


def merge_report(base: DataFrame, batch: DataFrame) -> DataFrame:
    """One row of sizes before, between and after the merge, from one pass."""

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    in_base, in_batch = F.col(_IN_BASE), F.col(_IN_BATCH)
    return _counted(base, batch).agg(
        total(in_base).alias("base_rows"),
        total(in_batch).alias("batch_rows"),
        total(in_base + in_batch).alias("concat_rows"),
        total(in_base + in_batch - 1).alias("duplicates_removed"),
        total(F.when(in_base == 0, 1).otherwise(0)).alias("new_rows"),
        F.count(F.lit(1)).alias("merged_rows"),
    )


def new_rows(
    base: DataFrame,
    batch: DataFrame,
    base_is_distinct: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Distinct rows of ``batch`` that ``base`` does not have.

    A base that may have duplicates is resolved in one shuffle of both tables.  With a
    distinct one the distinct batch is written once, see :func:`absent_rows`.
    """
    if base_is_distinct:
        rows = materialize(distinct_batch(base, batch), "distinct-batch")
        return absent_rows(base, rows, broadcast_bytes)
    fresh = _counted(base, batch).where(F.col(_IN_BASE) == 0)
    return fresh.drop(_IN_BASE, _IN_BATCH)


def distinct_batch(base: DataFrame, batch: DataFrame) -> DataFrame:
    """The distinct rows of ``batch`` with the columns that the union of both has."""
    return union_all(base.limit(0), batch).dropDuplicates()


def absent_rows(base: DataFrame, rows: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Those of the distinct, written ``rows`` that the distinct ``base`` does not have.

    If the measured size of ``rows`` fits a broadcast, the base is only scanned for its
    rows that occur in them, and those are taken out by a second broadcast.  Larger
    ``rows`` are put into a Bloom filter, some bytes a row: the base is scanned through
    it, and only what passes, little more than the rows in common, meets ``rows`` in a
    shuffle.  Rows whose filter is beyond the broadcast too are met by the whole base.
    """
    base = union_all(base, rows.limit(0))
    if size_in_bytes(rows) <= broadcast_bytes:
        known = materialize(_matching(base, rows, "left_semi"), "known-rows")
        return _matching(rows, known, "left_anti")
    passed = through_filter(base, rows, FILTER_BYTES)
    fresh = _counted(base if passed is None else passed, rows).where(F.col(_IN_BASE) == 0)
    return fresh.drop(_IN_BASE, _IN_BATCH)


def through_filter(base: DataFrame, rows: DataFrame, filter_bytes: int) -> DataFrame | None:
    """The rows of ``base`` that a Bloom filter of ``rows`` lets through; None if it would exceed ``filter_bytes``.

    All rows that occur in ``rows`` are among them.  The bits of a row grow with the
    logarithm of base / rows, so about as many others pass as there are ``rows``, or
    fewer.
    """
    count = rows.count()
    ratio = max(2.0, base.count() / max(count, 1))
    hashes = min(bloom.MOST_HASHES, max(bloom.HASHES, math.ceil(math.log2(ratio)) + 2))
    buckets = bloom.buckets_for(count, 2 * hashes)
    if buckets * bloom.BUCKET_BYTES > filter_bytes:
        return None
    bits = materialize(bloom.build(rows, bloom.row_hash(rows.schema), buckets, hashes), "batch-filter")
    named = bits.select(F.col(bloom.BUCKET).alias("__bucket"), F.col(bloom.WORDS).alias("__words"))
    hashed = base.withColumn("__hash", bloom.row_hash(base.schema))
    met = hashed.join(F.broadcast(named), bloom.bucket(F.col("__hash"), buckets) == F.col("__bucket"))
    return met.where(bloom.may_hold(F.col("__hash"), hashes, "__words")).select(*[F.col(f"`{c}`") for c in base.columns])


def _matching(rows: DataFrame, others: DataFrame, how: str) -> DataFrame:
    """``rows`` that occur in ``others`` (or do not), which is broadcast."""
    renamed = others.select(*[F.col(f"`{c}`").alias(f"__wanted_{c}") for c in rows.columns])
    same = F.lit(True)
    for name in rows.columns:
        same = same & F.col(f"`{name}`").eqNullSafe(F.col(f"`__wanted_{name}`"))
    return rows.join(F.broadcast(renamed), same, how)


def size_in_bytes(df: DataFrame) -> int:
    """Measured in-memory size of a table's rows (one aggregation job)."""
    width: Column = F.lit(16)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + 8 + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + 8 + F.octet_length(F.to_json(F.struct(column)))
        else:
            width = width + 16
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("n")).first().n

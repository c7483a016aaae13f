"""Bloom filters of whole rows, kept as tables and asked by Spark's own functions.

A filter is cut into buckets of 32,768 bits.  A row's hash names one bucket and some
bits in it, so a bucket is one row of the filter's table, and asking about many rows is
an equi-join on the bucket.  No bit array passes through the driver.  A filter of any
size is built in one shuffle: tasks set the bits of their rows, bucket by bucket, and
Spark joins those of a bucket, some two bytes a row.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_BITS = 1 << 15
#: With these a filter takes at most one row in 1,700 for one that it does not hold.
BITS_PER_ROW = 16
HASHES = 8
#: Most bits of a row in a filter; four come from one 64-bit hash.
MOST_HASHES = 24
#: Bytes of a bucket in memory: 1,024 words of 32 bits, each held in a long.
BUCKET_BYTES = 8 * BUCKET_BITS // 32

#: Buckets that a task holds at once when it builds a filter.
HELD_BUCKETS = 1 << 12

# task functions travel by value: executors need no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKET, WORDS = "bucket", "words"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)


def kinds(schema: T.StructType) -> dict[str, str]:
    """The type as which each column is hashed, by lower-case name."""
    found = {}
    for field in schema.fields:
        kind = field.dataType
        name = "bigint" if isinstance(kind, _INTEGRAL) else "double" if isinstance(kind, _FRACTIONAL) else kind.simpleString()
        found[field.name.lower()] = name
    return found


def comparable(first: dict[str, str], second: dict[str, str]) -> bool:
    """Whether equal rows of tables with these :func:`kinds` have equal hashes; absent columns are NULL."""
    return all(second.get(name, kind) == kind for name, kind in first.items())


def row_hash(schema: T.StructType) -> Column:
    """64 bits of a row, the same for rows that GROUP BY takes as equal.

    A NULL cell adds nothing, so a table without a column hashes like one in which
    the column is NULL; the order of columns does not count.
    """
    cells = []
    for field in schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, _INTEGRAL):
            value = value.cast("long")
        elif isinstance(field.dataType, _FRACTIONAL):
            value = F.when(value == 0, F.lit(0.0)).otherwise(value.cast("double"))  # -0.0 equals 0.0
        cells.append(F.when(value.isNotNull(), F.xxhash64(F.lit(field.name.lower()), value)).otherwise(F.lit(0).cast("long")))
    return reduce(lambda a, b: a.bitwiseXOR(b), cells)


def buckets_for(rows: int, bits_per_row: int = BITS_PER_ROW) -> int:
    """How many buckets hold so many rows: a power of two."""
    return 1 << max(0, (max(rows, 1) * bits_per_row - 1) // BUCKET_BITS).bit_length()


def bucket(hash_: Column, buckets: Column | int) -> Column:
    return F.xxhash64(hash_).bitwiseAND((F.lit(buckets) if isinstance(buckets, int) else buckets).cast("long") - 1)


def _positions(hash_: Column, hashes: int) -> list[Column]:
    """Bits of a row in its bucket."""
    if not 1 <= hashes <= MOST_HASHES:
        raise ValueError(f"a row has between 1 and {MOST_HASHES} bits")
    return [
        F.shiftrightunsigned(F.xxhash64(hash_, F.lit(1 + i // 4)), 15 * (i % 4)).bitwiseAND(F.lit(BUCKET_BITS - 1))
        for i in range(hashes)
    ]


def build(rows: DataFrame, hash_: Column, buckets: int, hashes: int = HASHES, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, bucket, rows, words): the filter's buckets that hold rows, for each group of ``by``.

    ``words`` are the bucket's bits, 32 to a word.  Equal rows count once each in ``rows``.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, int] = {}  # (*by, bucket) -> its place
        bits, counts = np.zeros((HELD_BUCKETS, BUCKET_BITS // 8), np.uint8), np.zeros(HELD_BUCKETS, np.int64)

        def closed() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*held, strict=True), key_types, strict=True)]
            made = [pa.array(counts[: len(held)]), pa.array([bits[i].tobytes() for i in held.values()], pa.binary())]
            return pa.RecordBatch.from_arrays([*columns, *made], names=[*by, BUCKET, "rows", "bits"])

        for batch in batches:
            key_types = [batch.column(name).type for name in (*by, BUCKET)]
            code = batch.column(BUCKET).to_numpy()
            for name in by:
                place = batch.column(name).dictionary_encode()
                code = code * (len(place.dictionary) + 1) + place.indices.fill_null(len(place.dictionary)).to_numpy()
            _, first, of_row = np.unique(code, return_index=True, return_inverse=True)
            keys = list(zip(*[batch.column(name).take(pa.array(first)).to_pylist() for name in (*by, BUCKET)], strict=True))
            for at in range(0, len(keys), HELD_BUCKETS):
                some = keys[at : at + HELD_BUCKETS]
                if len(held) + len(some) > HELD_BUCKETS:
                    yield closed()
                    held.clear()
                    bits[:], counts[:] = 0, 0
                places = np.array([held.setdefault(k, len(held)) for k in some])
                mine = np.flatnonzero((of_row >= at) & (of_row < at + len(some)))
                place = places[of_row[mine] - at]
                np.add.at(counts, place, 1)
                for i in range(hashes):
                    bit = batch.column(f"h{i // 4}").to_numpy()[mine] >> (15 * (i % 4)) & (BUCKET_BITS - 1)
                    np.bitwise_or.at(bits, (place, bit >> 3), (1 << (bit & 7)).astype(np.uint8))
        if held:
            yield closed()

    _positions(hash_, hashes)  # checks their number
    drawn = [F.xxhash64(hash_, F.lit(1 + i)).alias(f"h{i}") for i in range(-(-hashes // 4))]
    placed = rows.select(*by, bucket(hash_, buckets).alias(BUCKET), *drawn)
    kinds_ = "".join(f"`{name}` {rows.schema[name].dataType.simpleString()}, " for name in by)
    parts = placed.mapInArrow(partial, f"{kinds_}{BUCKET} long, rows long, bits binary")
    bits = parts.groupBy(*by, BUCKET).agg(F.sum("rows").alias("rows"), F.bitmap_or_agg("bits").alias("__bits"))
    word = F.transform(
        F.sequence(F.lit(0), F.lit(BUCKET_BITS // 32 - 1)),
        lambda i: F.conv(F.hex(F.substring("__bits", i * 4 + 1, F.lit(4))), 16, 10).cast("long"))
    return bits.select(*by, BUCKET, "rows", word.alias(WORDS))


def may_hold(hash_: Column, hashes: int = HASHES, words: str = WORDS) -> Column:
    """Whether the bucket ``words`` has every bit of the row; never false for a row that the filter holds."""
    tests = []
    for bit in _positions(hash_, hashes):
        # a word's first byte is its highest
        shift = (3 - F.shiftright(bit, 3).bitwiseAND(F.lit(3))) * 8 + bit.bitwiseAND(F.lit(7))
        word = F.get(F.col(words), F.shiftright(bit, 5).cast("int"))
        tests.append(F.call_function("shiftright", word, shift.cast("int")).bitwiseAND(F.lit(1)) != 0)
    return reduce(lambda a, b: a & b, tests)

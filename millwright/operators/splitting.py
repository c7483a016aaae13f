"""Exact stratified train/test split without moving the data.

Rows of a class are ordered by a seeded digest of their key (or of the whole
row).  The first ``quota`` of them are train rows, the others test rows, so the
split is the same under any partitioning and has exact class proportions.

No class is ever sorted.  The digest at the quota of each class (its cut) is
found by counting: one aggregation by the first digits of the digest, then, if
needed, by the next digits of the one group that holds the cut.  With the cuts
known, a row's side is a comparison; the rows are never shuffled.

Copies of one row share a digest.  If a cut falls among copies, the copies on
either side are counted, not ranked, and written out again from the counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.functions.digests import row_digest
from millwright.schema import TARGET, require_columns
from millwright.sources.readings import SPLIT
from millwright.sources.scratch import scratch_tables

# Share of test rows and seed.
TEST_SIZE = 0.2
SEED = 42

MAX_CLASSES = 10_000
RANK_ROWS = 1_000_000
COPIES_PER_TASK = 1_000_000

_DIGITS = 3  # hex digits per counting step: 4,096 groups
_FULL = 32  # hex digits of one digest
_LAST = "g"  # sorts after every hex digit

_CLASS, _DIGEST, _ROW_DIGEST = "__class", "__digest", "__row_digest"


def train_quotas(counts: dict, test_size: float = TEST_SIZE) -> dict:
    """Train rows per class from the rows per class.

    ``ceil(test_size * n)`` rows go to test.  Each class gets the floor of its
    share of the train rows; rows left over go to the largest remainders, ties
    by class value.
    """
    total = sum(counts.values())
    n_test = math.ceil(test_size * total)
    n_train = total - n_test
    small = sorted(str(c) for c, n in counts.items() if n < 2)
    if small:
        raise ValueError(f"classes with fewer than 2 rows: {small}")
    if min(n_train, n_test) < len(counts):
        raise ValueError(f"{n_train} train / {n_test} test rows for {len(counts)} classes")
    quotas = {c: n * n_train // total for c, n in counts.items()}
    spare = n_train - sum(quotas.values())
    by_remainder = sorted(counts, key=lambda c: (-(counts[c] * n_train % total), c))
    for c in by_remainder[:spare]:
        quotas[c] += 1
    return quotas


@dataclass
class _Cut:
    """Where a class is divided: ``take`` of the ``size`` rows at ``prefix`` are train.

    ``prefix`` grows to the full key digest and, where rows that share it are
    divided, on to the row digest.
    """

    take: int
    size: int
    prefix: str = ""

    @property
    def open(self) -> bool:
        return 0 < self.take < self.size

    def searching(self, end: int) -> bool:
        return self.open and len(self.prefix) < end

    def bounds(self) -> tuple[str, str]:
        """Largest (key digest, row digest) of a train row."""
        if self.take == 0:
            return "", ""
        by_key, by_row = self.prefix[:_FULL], self.prefix[_FULL:]
        return (
            by_key if len(by_key) == _FULL else by_key + _LAST,
            by_row if len(by_row) == _FULL else by_row + _LAST,
        )


def stratified_split(
    df: DataFrame,
    label: str = TARGET,
    key: Sequence[str] | None = None,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    rank_rows: int = RANK_ROWS,
    max_classes: int = MAX_CLASSES,
) -> DataFrame:
    """``df`` with a ``split`` column of ``train`` and ``test``.

    ``key`` names the columns that order the rows (default: all).  Counting
    jobs run when this is called; ``df`` is scanned again for the result, so
    pass a table rather than an expensive query.  More than ``max_classes``
    classes raise: their quotas are a broadcast table.
    """
    require_columns(df, [label, *(key or [])])
    digested = df.withColumn(_DIGEST, row_digest(key or df.columns, seed))
    cuts = _first_cuts(digested, label, test_size, max_classes)
    _search(cuts, digested, label, _DIGEST, 0, rank_rows)
    row_digests = None
    if key and any(cut.open for cut in cuts.values()):
        # rows that share a key are divided by their other columns
        row_digests = row_digest(df.columns, seed)
        shared = _rows_at(cuts, digested, label, _DIGEST, 0, _FULL)
        shared = shared.withColumn(_ROW_DIGEST, row_digests)
        _search(cuts, shared, label, _ROW_DIGEST, _FULL, rank_rows)
    return _assign(df, digested, row_digests, cuts, label)


def _cut_table(df: DataFrame, label: str, rows: list[tuple], fields: dict) -> DataFrame:
    """Per-class values as a table; its rows are bounded, so it is broadcast."""
    fields = {_CLASS: df.schema[label].dataType} | fields
    schema = T.StructType([T.StructField(name, kind) for name, kind in fields.items()])
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))


def _first_cuts(df: DataFrame, label: str, test_size: float, max_classes: int) -> dict:
    """Quota per class, and the group of first digits it ends in."""
    with scratch_tables(df.sparkSession) as tables:
        digits = F.substring(_DIGEST, 1, _DIGITS).alias("digits")
        counted = tables.write(
            df.groupBy(F.col(label).alias(_CLASS), digits).agg(F.count(F.lit(1)).alias("size")), "split-counts"
        )
        totals = counted.groupBy(_CLASS).agg(F.sum("size").alias("size"))
        classes = {r[_CLASS]: r["size"] for r in totals.limit(max_classes + 1).collect()}
        if not classes:
            raise ValueError("nothing to split")
        if None in classes:
            raise ValueError(f"{classes[None]} rows have no {label}")
        if len(classes) > max_classes:
            raise ValueError(f"{label} has more than {max_classes} values; not a class label")
        quotas = train_quotas(classes, test_size)
        cuts = {c: _Cut(quotas[c], n) for c, n in classes.items()}
        _narrow(cuts, counted, df, label, _FULL)
    return cuts


def _search(
    cuts: dict, df: DataFrame, label: str, digest: str, offset: int, rank_rows: int
) -> None:
    """Find each open cut's full digest, digit group by digit group.

    ``offset`` is where this digest starts in the prefixes.  As soon as the
    groups that hold a cut are small together, their digests are ranked.
    """
    end = offset + _FULL
    while waiting := [cut for cut in cuts.values() if cut.searching(end)]:
        known = max(len(cut.prefix) for cut in waiting) - offset
        inside = _rows_at(cuts, df, label, digest, offset, known)
        step = min(_DIGITS, _FULL - known)
        if sum(cut.size for cut in waiting) <= rank_rows:
            step = _FULL - known
        digits = F.substring(F.col(digest), known + 1, step)
        counted = inside.groupBy(F.col(label).alias(_CLASS), digits.alias("digits")).agg(
            F.count(F.lit(1)).alias("size"), F.min(digest).alias("low"), F.max(digest).alias("high")
        )
        _narrow(cuts, counted, df, label, end)


def _rows_at(
    cuts: dict, df: DataFrame, label: str, digest: str, offset: int, known: int
) -> DataFrame:
    """Rows whose first ``known`` digits are those of their class's open cut."""
    rows = [
        (c, cut.prefix[offset:])
        for c, cut in cuts.items()
        if cut.open and len(cut.prefix) == offset + known
    ]
    wanted = _cut_table(df, label, rows, {"__prefix": T.StringType()})
    head = F.substring(F.col(digest), 1, known)
    return df.join(
        wanted, (F.col(label) == F.col(_CLASS)) & (head == F.col("__prefix")), "left_semi"
    )


def _narrow(cuts: dict, counted: DataFrame, df: DataFrame, label: str, end: int) -> None:
    """Move every searched cut into its group of the next digits."""
    rows = [(c, cut.take) for c, cut in cuts.items() if cut.searching(end)]
    if not rows:
        return
    wanted = _cut_table(df, label, rows, {"take": T.LongType()})
    upto = W.partitionBy(_CLASS).orderBy("digits").rowsBetween(W.unboundedPreceding, 0)
    found = (
        counted.join(wanted, _CLASS)
        .withColumn("before", F.sum("size").over(upto) - F.col("size"))
        .where((F.col("before") < F.col("take")) & (F.col("take") <= F.col("before") + F.col("size")))
    )
    for row in found.collect():
        cut = cuts[row[_CLASS]]
        cut.prefix += row["digits"]
        cut.take, cut.size = row["take"] - row["before"], row["size"]
        if "low" in row and row["low"] == row["high"]:
            # one digest only, e.g. copies of a row: nothing left to search
            cut.prefix = cut.prefix[: end - _FULL] + row["low"]


def _assign(
    df: DataFrame, digested: DataFrame, row_digests: Column | None, cuts: dict, label: str
) -> DataFrame:
    columns = [F.col(f"`{c}`") for c in df.columns]
    if row_digests is not None:
        digested = digested.withColumn(_ROW_DIGEST, row_digests)
    rows = [(c, *cut.bounds()) for c, cut in cuts.items()]
    bounds = _cut_table(df, label, rows, {"__at": T.StringType(), "__row_at": T.StringType()})
    placed = digested.join(bounds, F.col(label) == F.col(_CLASS))
    is_train = F.col(_DIGEST) <= F.col("__at")
    if row_digests is not None:
        is_train = (F.col(_DIGEST) < F.col("__at")) | (
            (F.col(_DIGEST) == F.col("__at")) & (F.col(_ROW_DIGEST) <= F.col("__row_at"))
        )
    side = F.when(is_train, "train").otherwise("test").alias(SPLIT)
    divided = [(c, *cut.bounds(), cut.take) for c, cut in cuts.items() if cut.open]
    if not divided:
        return placed.select(*columns, side)

    copies = _cut_table(
        df, label, divided,
        {"__copy_at": T.StringType(), "__copy_row_at": T.StringType(), "__take": T.LongType()},
    )
    at_cut = (F.col(label) == copies[_CLASS]) & (F.col(_DIGEST) == F.col("__copy_at"))
    if row_digests is not None:
        at_cut = at_cut & (F.col(_ROW_DIGEST) == F.col("__copy_row_at"))
    clear = placed.drop(_CLASS).join(copies, at_cut, "left_anti").select(*columns, side)
    return clear.unionByName(_divide_copies(digested.join(copies, at_cut), columns, label))


def _divide_copies(rows: DataFrame, columns: Sequence[Column], label: str) -> DataFrame:
    """Copies of one row: the first ``__take`` to train, the rest to test.

    Grouping leaves one row per distinct row; the copies come back in chunks
    that are spread over the cluster before they are written out.
    """
    order = W.partitionBy(label).orderBy(*columns).rowsBetween(W.unboundedPreceding, 0)
    counted = (
        rows.groupBy(*columns, "__take")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.sum("__n").over(order) - F.col("__n"))
        .withColumn(
            "__train",
            F.least(F.col("__n"), F.greatest(F.lit(0), F.col("__take") - F.col("__before"))),
        )
    )
    sides = F.array(
        F.struct(F.lit("train").alias(SPLIT), F.col("__train").alias("__copies")),
        F.struct(F.lit("test").alias(SPLIT), (F.col("__n") - F.col("__train")).alias("__copies")),
    )
    per_side = counted.select(*columns, F.inline(sides)).where(F.col("__copies") > 0)
    size = F.lit(COPIES_PER_TASK)
    chunks = per_side.withColumn(
        "__chunk", F.explode(F.sequence(F.lit(0), F.ceil(F.col("__copies") / size) - 1))
    )
    in_chunk = F.least(size, F.col("__copies") - F.col("__chunk") * size)
    return (
        chunks.withColumn("__rows", in_chunk)
        .repartition(label, "__chunk", SPLIT)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__rows").cast("int"))))
        .select(*columns, SPLIT)
    )


def split_leakage(rows: DataFrame) -> DataFrame:
    """One row: distinct rows found in both splits, and how many rows they are."""
    keys = [F.col(f"`{c}`") for c in rows.columns if c != SPLIT]
    both = (
        rows.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(SPLIT).alias("first_side"),
            F.max(SPLIT).alias("last_side"),
        )
        .where(F.col("first_side") != F.col("last_side"))
    )
    return both.agg(
        F.count(F.lit(1)).alias("shared_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("affected_rows"),
    )

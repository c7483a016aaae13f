"""Exact dedup by a tree merge of sorted digest runs.

Every text is read once and becomes a digest.  A partition's digests are a sorted
run, in which equal ones are one entry: digest, length, the row that stays, and how
many rows there were.  The runs then meet in rounds.  With the partitions numbered
in base ``FAN_IN``, round j exchanges runs among the partitions that differ only in
digit j: each cuts its run by the j-th digit of the digests and sends a slice to
each partner, which merges what it gets.  After the last round a partition holds
one range of the digest space, complete.  So no round brings more than ``FAN_IN``
slices of one run each to a partition, and a digest that a third of all rows share
is one entry from the first run on.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.sources.scratch import materialize

FAN_IN = 8
#: Documents per partition that the number of rounds is chosen for.
RUN_ROWS = 25_000
NO_ID = np.iinfo(np.int64).min

#: keep, row: the row that stays; length: bytes of the text, a second check of equality.
ENTRY = np.dtype([("digest", "S32"), ("length", "<i8"), ("keep", "<i8"), ("row", "<i8"), ("count", "<i8")])


def merge_runs(runs: list[np.ndarray], largest: bool) -> np.ndarray:
    """One sorted run of several; of equal digests the row with the extreme id stays.

    Among rows of that id the first one stays.  Equal digests of texts of different
    length would be a collision and raise.
    """
    rows = np.concatenate(runs) if runs else np.zeros(0, ENTRY)
    if len(rows) == 0:
        return rows
    rows = rows[np.argsort(rows["digest"], kind="stable")]  # merges the sorted runs
    first = np.flatnonzero(np.concatenate([[True], rows["digest"][1:] != rows["digest"][:-1]]))
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(rows))))
    if (rows["length"] != rows["length"][first][group]).any():
        raise ValueError("texts of different length have one digest")
    nameless = rows["keep"] == NO_ID  # after any id
    best = np.lexsort((rows["row"], -rows["keep"] if largest else rows["keep"], nameless, group))
    merged = rows[best][first]
    merged["count"] = np.add.reduceat(rows["count"], first)
    return merged


def _place(digests: np.ndarray, levels: int) -> np.ndarray:
    """The partition, of FAN_IN ** levels, whose range of the digest space holds each digest."""
    head = digests.view(np.uint8).reshape(-1, 32)[:, :4].copy().view(">u4").ravel().astype(np.uint64)
    return (head * np.uint64(FAN_IN**levels) >> np.uint64(32)).astype(np.int64)


def _slices(run: np.ndarray, at: int, round_: int, levels: int) -> Iterator[tuple[int, bytes]]:
    """The run of partition ``at``, cut for its partners of a round: (partition, slice)."""
    unit = FAN_IN ** (levels - 1 - round_)
    digit = _place(np.ascontiguousarray(run["digest"]), levels) // unit % FAN_IN
    for value in np.unique(digit):
        yield int(at + (value - at // unit % FAN_IN) * unit), run[digit == value].tobytes()


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, length, text_sha256) of every row; A-Z count as a-z, a null text as empty."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(value.as_py() or "").encode().lower() for value in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())],
                names=["doc_id", "row", "length", "text_sha256"])

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.col(text).alias("text"))
    return rows.mapInArrow(hashed, "doc_id long, row long, length long, text_sha256 string")


def merged_runs(rows: DataFrame, largest: bool) -> DataFrame:
    """(text_sha256, keep_id, keep_row, group_size) of the digests of two rows or more.

    ``rows`` is a written table as :func:`digests` gives it.
    """
    levels = max(1, math.ceil(math.log(max(1, rows.count() / RUN_ROWS), FAN_IN)))
    places = FAN_IN**levels

    def first_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() % places
        runs = []
        for batch in batches:
            run = np.zeros(batch.num_rows, ENTRY)
            run["digest"] = [bytes.fromhex(x) for x in batch.column(3).to_pylist()]
            run["length"], run["row"], run["count"] = batch.column(2), batch.column(1), 1
            run["keep"] = batch.column(0).fill_null(NO_ID)
            runs.append(run)
        yield _sent(_slices(merge_runs(runs, largest), at, 0, levels))

    def exchange(round_: int):
        def merge(group: pa.Table) -> pa.Table:
            at = group.column("place")[0].as_py()
            runs = [np.frombuffer(x.as_buffer(), ENTRY) for x in group.column("run")]
            return pa.Table.from_batches([_sent(_slices(merge_runs(runs, largest), at, round_, levels))])

        return merge

    def finish(group: pa.Table) -> pa.Table:
        run = merge_runs([np.frombuffer(x.as_buffer(), ENTRY) for x in group.column("run")], largest)
        run = run[run["count"] > 1]
        raw = run["digest"].astype("S32").tobytes()
        return pa.table({
            "text_sha256": pa.array([raw[i : i + 32].hex() for i in range(0, len(raw), 32)], pa.string()),
            "keep_id": pa.array(run["keep"], pa.int64(), mask=run["keep"] == NO_ID),
            "keep_row": pa.array(run["row"], pa.int64()), "group_size": pa.array(run["count"], pa.int64())})

    sent = rows.select("doc_id", "row", "length", "text_sha256").mapInArrow(first_runs, "place int, run binary")
    for round_ in range(1, levels):
        sent = sent.groupBy("place").applyInArrow(exchange(round_), "place int, run binary")
    return sent.groupBy("place").applyInArrow(
        finish, "text_sha256 string, keep_id long, keep_row long, group_size long")


def _sent(slices: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
    rows = list(slices)
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.binary())],
        names=["place", "run"])


def exact_dedup(docs: DataFrame, largest: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z.  Of equal ones the row
    with the smallest ``doc_id`` stays, or with the largest; of repeated rows of
    that id one stays.  A null id loses against any other; a null text is an empty
    one, and texts of any length go into their digest whole.  Ids are whole numbers.
    Other columns are not read.
    """
    rows = materialize(digests(docs, doc_id, text), "exact-digests")
    groups = materialize(merged_runs(rows, largest), "exact-groups")
    groups = groups.withColumnRenamed("text_sha256", "__sha")
    joined = rows.join(groups, F.col("text_sha256") == F.col("__sha"), "left")
    return joined.select(
        "doc_id",
        F.when(F.col("__sha").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        "text_sha256")

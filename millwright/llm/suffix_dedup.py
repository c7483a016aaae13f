"""Removal of passages that an earlier document has, by sorting suffixes.

A byte goes if a string of ``WIDTH`` bytes that covers it also starts in a document
with a smaller id.  Sorting every suffix of a corpus would move each text fifty
times over, so first the suffixes that cannot repeat are ruled out:

1. Texts that are equal as a whole are one text with its smallest id.
2. The texts are written once, bucketed into slices of some MB; what follows reads
   them in place and moves only what it sends.
3. Every window of ``WIDTH`` bytes names the gram in it with the smallest hash, so
   equal windows name equal grams.  Each slice sends the hashes of the named grams,
   forty bits each, to ranges of the hash space; a range answers which of them are
   in two texts or more.
4. For those, slices send the stretch of text whose windows name the gram, equal
   stretches once.  A gram that very many slices share would be one range's burden;
   its windows are sent one by one, to ranges by their own hash.
5. A range sorts the suffixes of its stretches (deep-shallow, see ``suffix_sort``),
   finds the smallest id of each window, and answers which windows go.
6. Slices join the windows into spans and hash what is left.

Hashes only choose what is compared; that two windows are equal is decided on their
bytes.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm.suffix_sort import sort_suffixes
from millwright.sources.scratch import discard, fresh_path, materialize, scratch_tables

WIDTH = 50
GRAM = 20
SLICE_BYTES = 2 << 20
#: Bytes of text per range: a fifteenth of them start a named gram.
RANGE_BYTES = 4 << 20
#: Bytes of text whose grams are hashed at a time.
BLOCK_BYTES = 64 << 10
#: Spark's own bound on buckets is higher; a bucket holds as many slices as it must.
MAX_BUCKETS = 10_000
#: A gram that more slices than this share is compared window by window.
HOT_SLICES = 256
NO_ID = np.iinfo(np.int64).max
IDS, SHARED, GONE = 0, 1, 2

_BYTE = np.random.default_rng(20240531).integers(1 << 62, 1 << 63, 256, np.uint64)
_U = np.uint64


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (b * _U(0x9E3779B97F4A7C15) + (a >> _U(29)))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def _combined(values: np.ndarray, length: int, combine) -> np.ndarray:
    """``combine`` over every stretch of ``length`` values, by doubling."""
    n, found = 1, values
    while n * 2 <= length:
        found = combine(found[:-n], found[n:])
        n *= 2
    if n < length:
        found = combine(found[: len(values) - length + 1], found[length - n :])
    return found


def _range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    return ((h >> _U(32)) * _U(ranges) >> _U(32)).astype(np.int64)


def _named_grams(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of texts end to end: where a named gram is, its hash, the first window that names it and how many do."""
    window = width - gram + 1
    grams = _combined(_BYTE[text], gram, _mix) | _U(1)
    least = _combined(grams, window, np.minimum)
    valid = np.zeros(len(least) + 1, np.int8)  # windows that end in the text where they start
    np.add.at(valid, starts, 1)
    np.add.at(valid, ends - width + 1, -1)
    least[np.cumsum(valid[:-1], dtype=np.int8) == 0] = 0
    edge = np.zeros(window - 1, np.uint64)
    least = np.concatenate([edge, least, edge])
    top = ~_combined(~least, window, np.minimum)
    at = np.flatnonzero(top == grams)
    names = sliding_window_view(least, window)[at] == grams[at, None]
    return at, grams[at], at - window + 1 + names.argmax(axis=1), names.sum(axis=1)


class Slice:
    """The texts of a slice, end to end, and the grams that their windows name."""

    def __init__(self, texts: list[bytes], width: int, gram: int, ranges: int):
        self.width, self.ranges, self.most = width, ranges, width + width - gram
        self.text = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts])
        self.starts = self.ends - [len(t) for t in texts]
        found, first = [], 0
        while first < len(texts):  # some texts at a time, to stay in the cache
            end = max(first + 1, int(np.searchsorted(self.ends, self.starts[first] + BLOCK_BYTES)))
            base = self.starts[first]
            at, h, start, many = _named_grams(
                self.text[base : self.ends[end - 1]], self.starts[first:end] - base, self.ends[first:end] - base, width, gram)
            found.append((at + base, h, start + base, many))
            first = end
        at, self.hash, self.first, self.many = map(np.concatenate, zip(*found, strict=True))
        self.doc = np.searchsorted(self.ends, at, side="right")
        h = _mix(self.hash, self.hash)  # the smallest hashes of windows are small
        #: range and the low forty bits of the hash
        self.key = _range_of(h, ranges) << 40 | (h & _U((1 << 40) - 1)).astype(np.int64)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys in order, and whether two texts of this slice have them."""
        order = np.argsort(self.key, kind="stable")
        key, doc = self.key[order], self.doc[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        if not len(first):
            return key, np.zeros(0, bool)
        return key[first], np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)


@dataclass
class Stretches:
    """What a slice sends of its candidate text: distinct stretches in order of range.

    ``of`` is the stretch of each occurrence, whose first window is ``first``.
    """

    of: np.ndarray
    first: np.ndarray
    many: np.ndarray
    doc: np.ndarray
    range: np.ndarray  # per distinct stretch
    sample: np.ndarray  # an occurrence of it
    id: np.ndarray  # its smallest id


def _content(text: np.ndarray, first: np.ndarray, length: np.ndarray, most: int) -> np.ndarray:
    """The bytes of each stretch, padded, as rows of eight-byte words."""
    words = -(-most // 8)
    padded = np.concatenate([text, np.zeros(8 * words, np.uint8)])
    inside = (np.arange(8 * words) < np.arange(most + 1)[:, None]).astype(np.uint8) * np.uint8(255)
    rows = sliding_window_view(padded, 8 * words)[first].view(np.uint64)
    rows &= inside.view(np.uint64)[length]
    return rows


def _alike(words: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal rows together, and where new ones begin in it.

    Rows are ordered by a hash; rows that only share the hash are kept apart.
    """
    h = np.full(len(words), 1, np.uint64)
    for column in (*words.T, *(x.astype(np.uint64) for x in more)):
        h = _mix(h, column)
    order = np.lexsort((h, *more))
    new = np.ones(len(words), bool)
    new[1:] = (words[order][1:] != words[order][:-1]).any(axis=1)
    for x in more:
        new[1:] |= x[order][1:] != x[order][:-1]
    return order, new


def _stretches(piece: Slice, ids: np.ndarray, shared: np.ndarray, hot: np.ndarray) -> Stretches:
    """Candidate stretches of a slice; ``shared`` and ``hot`` follow its distinct keys."""
    keys, _ = piece.keys()
    mark = np.searchsorted(keys, piece.key)
    chosen = np.flatnonzero(shared[mark]) if len(keys) else np.zeros(0, np.int64)
    first, many = piece.first[chosen], piece.many[chosen]
    doc, range_ = piece.doc[chosen], piece.key[chosen] >> 40
    single = hot[mark[chosen]] if len(keys) else np.zeros(0, bool)
    if single.any():  # one stretch per window, ranged by its content
        n = many[single]
        windows = np.repeat(first[single], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        words = _content(piece.text, windows, np.full(len(windows), piece.width), piece.width)
        h = np.full(len(words), 1, np.uint64)
        for column in words.T:
            h = _mix(h, column)
        first = np.concatenate([first[~single], windows])
        many = np.concatenate([many[~single], np.ones(len(windows), np.int64)])
        doc = np.concatenate([doc[~single], np.repeat(doc[single], n)])
        range_ = np.concatenate([range_[~single], _range_of(h, piece.ranges)])
    order, new = _alike(_content(piece.text, first, many + piece.width - 1, piece.most), many, range_)
    begin = np.flatnonzero(new)
    of = np.zeros(len(first), np.int64)
    of[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(ids[doc][order], begin) if len(begin) else np.zeros(0, np.int64)
    return Stretches(of, first, many, doc, range_[order[begin]], order[begin], least)


# ---- messages between slices and ranges -------------------------------------


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    kinds = {"slice": pa.int64(), "kind": pa.int32(), "range": pa.int64(), "blob": pa.binary()}
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table({n: pa.array(c, kinds[n]) for n, c in zip(names, columns, strict=True)})


def _segments(range_: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(range, first, end) of sorted ranges."""
    first = np.flatnonzero(np.concatenate([[True], range_[1:] != range_[:-1]])) if len(range_) else []
    for a, b in zip(first, [*first[1:], len(range_)], strict=True) if len(first) else ():
        yield int(range_[a]), int(a), int(b)


def _pack_keys(keys: np.ndarray, several: np.ndarray) -> bytes:
    low = (keys & ((1 << 40) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    return np.ascontiguousarray(low).tobytes() + np.packbits(several).tobytes()


def _unpack_keys(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) * 8 // 41  # 40 bits and one
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :5] = np.frombuffer(blob, np.uint8, 5 * n).reshape(n, 5)
    return wide.view("<u8").ravel(), np.unpackbits(np.frombuffer(blob, np.uint8, offset=5 * n), count=n).astype(bool)


def _find_shared(group: pa.Table, hot_slices: int) -> pa.Table:
    """Which of each slice's keys in this range are in two texts or more, and which are hot."""
    slices, blobs = group.column("slice").to_pylist(), group.column("blob").to_pylist()
    range_ = group.column("range")[0].as_py()
    parts = [_unpack_keys(b) for b in blobs]
    value = np.concatenate([p[0] for p in parts])
    order = np.argsort(value, kind="stable")
    sorted_ = value[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    group_of = np.cumsum(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) - 1
    many = np.diff(np.append(first, len(value)))
    several = np.logical_or.reduceat(np.concatenate([p[1] for p in parts])[order], first)
    shared, hot = np.zeros(len(value), bool), np.zeros(len(value), bool)
    shared[order] = ((many > 1) | several)[group_of]
    hot[order] = (many > hot_slices)[group_of]
    rows, at = [], 0
    for name, (keys, _) in zip(slices, parts, strict=True):
        end = at + len(keys)
        if shared[at:end].any():
            rows.append((name, SHARED, range_, np.packbits(shared[at:end]).tobytes() + np.packbits(hot[at:end]).tobytes()))
        at = end
    return _batch(rows, ("slice", "kind", "range", "blob"))


def _pack_stretches(piece: Slice, found: Stretches, first: int, end: int) -> bytes:
    sample = found.sample[first:end]
    begin, many = found.first[sample], found.many[sample]
    length = many + piece.width - 1
    at = np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(length.sum())
    return b"".join([
        np.array([end - first], "<u4").tobytes(), found.id[first:end].astype("<i8").tobytes(),
        many.astype(np.uint8).tobytes(), piece.text[at].tobytes()])


def _sort_range(group: pa.Table, width: int) -> pa.Table:
    """Which windows of each slice's stretches start in a text with a smaller id than theirs."""
    slices, blobs = group.column("slice").to_pylist(), group.column("blob").to_pylist()
    range_ = group.column("range")[0].as_py()
    counts, ids, many, texts = [], [], [], []
    for blob in blobs:
        n = int(np.frombuffer(blob, "<u4", 1)[0])
        counts.append(n)
        ids.append(np.frombuffer(blob, "<i8", n, 4))
        many.append(np.frombuffer(blob, np.uint8, n, 4 + 8 * n).astype(np.int64))
        texts.append(np.frombuffer(blob, np.uint8, offset=4 + 9 * n))
    ids, many, text = np.concatenate(ids), np.concatenate(many), np.concatenate(texts)
    length = many + width - 1
    begin = np.cumsum(length) - length
    order, new = _alike(_content(text, begin, length, int(length.max())), many)
    stretch = np.zeros(len(ids), np.int64)  # equal ones have their suffixes sorted once
    stretch[order] = np.cumsum(new) - 1
    firsts = np.flatnonzero(new)
    least = np.minimum.reduceat(ids[order], firsts)
    once = order[firsts]
    n = many[once]
    base = np.cumsum(n) - n
    suffix = np.repeat(begin[once] - base, n) + np.arange(n.sum())
    by, starts = sort_suffixes(text, suffix, width)
    first = np.flatnonzero(starts)
    smallest = np.zeros(len(suffix), np.int64)
    smallest[by] = np.minimum.reduceat(np.repeat(least, n)[by], first)[np.cumsum(starts) - 1]
    number = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    gone = smallest[np.repeat(base[stretch], many) + number] < np.repeat(ids, many)
    mask = np.add.reduceat(gone.astype(np.uint64) << number.astype(np.uint64), np.cumsum(many) - many)
    rows, at = [], 0
    for name, count in zip(slices, counts, strict=True):
        if mask[at : at + count].any():
            rows.append((name, GONE, range_, mask[at : at + count].astype("<u8").tobytes()))
        at += count
    return _batch(rows, ("slice", "kind", "range", "blob"))


# ---- work on slices ---------------------------------------------------------


class _Work:
    """A slice's texts with what was sent to it; the same in every pass."""

    def __init__(self, texts: pa.Table, sent: pa.Table | None, width: int, gram: int, ranges: int):
        by_digest = dict(zip(texts.column("digest").to_pylist(), texts.column("text").to_pylist(), strict=True))
        self.digests = sorted(by_digest)
        self.texts = [by_digest[d] for d in self.digests]
        self.piece = Slice(self.texts, width, gram, ranges)
        if sent is None:
            return
        kinds, places, blobs = (sent.column(c).to_pylist() for c in ("kind", "range", "blob"))
        self.sent = {(k, r): b for k, r, b in zip(kinds, places, blobs, strict=True)}
        known = self.sent[IDS, 0]
        ids = {known[i : i + 32]: int.from_bytes(known[i + 32 : i + 40], "little", signed=True) for i in range(0, len(known), 40)}
        self.ids = np.array([ids[d] for d in self.digests], np.int64)
        keys, _ = self.piece.keys()
        shared, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        for range_, a, b in _segments(keys >> 40):
            if bits := self.sent.get((SHARED, range_)):
                half = len(bits) // 2
                shared[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8, half), count=b - a)
                hot[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8, offset=half), count=b - a)
        self.found = _stretches(self.piece, self.ids, shared, hot)


def _removed(work: _Work) -> np.ndarray:
    """For each byte of a slice whether it goes."""
    found, piece = work.found, work.piece
    mask = np.zeros(len(found.sample), np.uint64)
    for range_, a, b in _segments(found.range):
        if blob := work.sent.get((GONE, range_)):
            mask[a:b] = np.frombuffer(blob, "<u8")
    # a copy with a larger id than the one that was judged loses every window
    every = work.ids[found.doc] > found.id[found.of]
    number = np.arange(found.many.sum()) - np.repeat(np.cumsum(found.many) - found.many, found.many)
    bits = np.repeat(mask[found.of], found.many) >> number.astype(np.uint64) & _U(1)
    goes = (bits == 1) | np.repeat(every, found.many)
    windows = (np.repeat(found.first, found.many) + number)[goes]
    change = np.zeros(len(piece.text) + 1, np.int64)
    np.add.at(change, windows, 1)
    np.add.at(change, windows + piece.width, -1)
    return np.cumsum(change[:-1]) > 0


RESULT = "digest binary, id long, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def _result(work: _Work | None) -> pa.Table:
    """The texts of a slice that lose bytes."""
    rows, texts = [], []
    if work is not None:
        gone = _removed(work)
        texts = zip(work.digests, work.ids.tolist(), work.piece.starts, work.piece.ends, strict=True)
    for digest, id_, start, end in texts:
        own = gone[start:end]
        if not own.any():
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
        spans = [{"start": a, "end": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
        kept = work.piece.text[start:end][~own].tobytes()
        rows.append((digest, id_, int(own.sum()), hashlib.sha256(kept).hexdigest(), spans))
    columns = list(zip(*rows, strict=True)) or [()] * 5
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table({
        "digest": pa.array(columns[0], pa.binary()), "id": pa.array(columns[1], pa.int64()),
        "n_removed": pa.array(columns[2], pa.int64()), "kept_sha256": pa.array(columns[3], pa.string()),
        "spans": pa.array(columns[4], span)})


# ---- the job ----------------------------------------------------------------


def _slice_texts(docs: DataFrame, text: str, width: int, slices: int) -> DataFrame:
    """(slice, digest, text): a partition's distinct texts of ``width`` bytes or more."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            rows = []
            for value in batch.column(0):
                raw = value.as_buffer().to_pybytes() if value.is_valid else b""
                if len(raw) >= width and (digest := hashlib.sha256(raw).digest()) not in seen:
                    seen.add(digest)
                    rows.append((int.from_bytes(digest[:7], "big") % slices, digest, raw))
            columns = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())],
                names=["slice", "digest", "text"])

    return docs.select(F.col(text).cast("string")).mapInArrow(cut, "slice long, digest binary, text binary")


def _bucketed(spark: SparkSession, rows: DataFrame, buckets: int) -> tuple[DataFrame, str, str]:
    """``rows`` as a table bucketed by slice in the shared folder, its name and path."""
    name, path = f"texts_{uuid.uuid4().hex}", fresh_path(spark, "suffix-texts")
    rows.repartition(buckets, "slice").write.bucketBy(buckets, "slice").sortBy("slice").option("path", path).saveAsTable(name)
    return spark.table(name), name, path


def _ids(rows: DataFrame, width: int, slices: int) -> DataFrame:
    """A message per slice: the digests of its texts and their smallest ids."""
    number = F.conv(F.substring("sha", 1, 14), 16, 10).cast("long") % slices
    least = rows.where(F.col("n_bytes") >= width).groupBy("sha").agg(F.min("id").alias("id"))

    def joined(group: pa.Table) -> pa.Table:
        pairs = zip(group.column("sha").to_pylist(), group.column("id").to_pylist(), strict=True)
        blob = b"".join(bytes.fromhex(s) + i.to_bytes(8, "little", signed=True) for s, i in pairs)
        return _batch([(group.column("slice")[0].as_py(), IDS, 0, blob)], ("slice", "kind", "range", "blob"))

    return least.withColumn("slice", number).groupBy("slice").applyInArrow(joined, MESSAGE)


MESSAGE = "slice long, kind int, range long, blob binary"


def repeated_passages(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, text: str = "text", doc_id: str = "doc_id",
                      slice_bytes: int = SLICE_BYTES, range_bytes: int = RANGE_BYTES,
                      hot_slices: int = HOT_SLICES) -> DataFrame:
    """One row per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    Texts are UTF-8 bytes; ``spans`` are the maximal runs of bytes that go, in order.
    Every byte is judged on the input: one goes if any window of ``width`` bytes over
    it also starts in a text with a smaller id.  A null text is empty; a text shorter
    than ``width`` keeps all.  Rows of equal id and text do not remove from each
    other.  A row without an id comes after every other; ids are whole numbers.  Other
    columns are not read.  A task holds some slices' or ranges' MB, and at least one whole text.
    """
    if not gram + 12 <= width <= gram + 63 or width < 32:
        raise ValueError("a window must have at least 32 bytes, and name one of 13 to 64 grams")
    spark = docs.sparkSession
    none = hashlib.sha256(b"").hexdigest()
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(int(NO_ID))).alias("id"),
        F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias("sha"),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"))
    rows = materialize(rows, "suffix-rows")
    total = rows.where(F.col("n_bytes") >= width).groupBy("sha").agg(F.first("n_bytes").alias("n")).agg(F.sum("n")).first()[0]
    if total is None:
        found = spark.createDataFrame([], RESULT)
    else:
        found = _judged(docs, rows, text, width, gram, -(-total // slice_bytes), -(-total // range_bytes), hot_slices)
    found = found.select(
        F.lower(F.hex("digest")).alias("__sha"), F.col("id").alias("__id"), F.col("n_removed").alias("__removed"),
        F.col("kept_sha256").alias("__kept"), F.col("spans").alias("__spans"))
    joined = rows.join(_first_ids(rows, width), F.col("sha") == F.col("__of"), "left").join(
        found, F.col("sha") == F.col("__sha"), "left")
    copy = F.coalesce(F.col("id") > F.col("__least"), F.lit(False))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    spans = F.when(copy, whole).otherwise(F.coalesce("__spans", F.slice(whole, 1, 0)))
    zero = F.lit(0).cast("long")
    return joined.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("__removed", zero)).alias("n_removed"),
        F.size(spans).cast("long").alias("n_spans"),
        F.when(copy, F.lit(none)).otherwise(F.coalesce("__kept", "sha")).alias("kept_sha256"),
        spans.alias("spans"))


def _first_ids(rows: DataFrame, width: int) -> DataFrame:
    """(__of, __least) of the texts that rows of several ids have."""
    return rows.where(F.col("n_bytes") >= width).groupBy(F.col("sha").alias("__of")).agg(
        F.min("id").alias("__least"), F.max("id").alias("__most")).where("__least < __most").drop("__most")


def _judged(docs: DataFrame, rows: DataFrame, text: str, width: int, gram: int, slices: int, ranges: int,
            hot_slices: int) -> DataFrame:
    """The texts that lose bytes, one row each as in ``RESULT``."""
    spark = docs.sparkSession
    cut = _slice_texts(docs, text, width, slices)
    texts, name, path = _bucketed(spark, cut, min(slices, MAX_BUCKETS))
    by_slice = texts.groupBy("slice")

    def send_keys(group: pa.Table) -> pa.Table:
        work = _Work(group, None, width, gram, ranges)
        keys, several = work.piece.keys()
        at = group.column("slice")[0].as_py()
        return _batch([(at, r, _pack_keys(keys[a:b], several[a:b])) for r, a, b in _segments(keys >> 40)], ("slice", "range", "blob"))

    def send_stretches(key: tuple, group: pa.Table, sent: pa.Table) -> pa.Table:
        if not group.num_rows:
            return _batch([], ("slice", "range", "blob"))
        work = _Work(group, sent, width, gram, ranges)
        return _batch(
            [(key[0].as_py(), r, _pack_stretches(work.piece, work.found, a, b)) for r, a, b in _segments(work.found.range)],
            ("slice", "range", "blob"))

    def finish(group: pa.Table, sent: pa.Table) -> pa.Table:
        if not group.num_rows:
            return _result(None)
        return _result(_Work(group, sent, width, gram, ranges))

    try:
        with scratch_tables(spark) as tables:
            ids = _ids(rows, width, slices)
            keys = by_slice.applyInArrow(send_keys, "slice long, range long, blob binary")
            shared = keys.groupBy("range").applyInArrow(lambda g: _find_shared(g, hot_slices), MESSAGE)
            known = tables.write(ids.union(shared), "suffix-shared")
            stretches = by_slice.cogroup(known.groupBy("slice")).applyInArrow(
                send_stretches, "slice long, range long, blob binary")
            gone = stretches.groupBy("range").applyInArrow(lambda g: _sort_range(g, width), MESSAGE)
            known = known.union(tables.write(gone, "suffix-gone"))
            return materialize(by_slice.cogroup(known.groupBy("slice")).applyInArrow(finish, RESULT), "suffix-result")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        discard(spark, path)

"""Best-fit packing of tokenized documents, planned on the histogram of lengths.

A sequence holds ``capacity`` tokens, so there are at most that many lengths, and
which lengths go together can be planned on their counts alone: best-fit
decreasing over (length, count), where equal sequences are one entry with a
multiplicity.  The plan's size depends on the capacity and not on the documents.
Documents then take the planned slots by their rank within their length.  Ranks
are counted in two steps, within hash buckets of a length and over the buckets, so
that a length that most pieces have is no single task's.
"""

from __future__ import annotations

import bisect
import os
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.text import releasing, worker_cache
from millwright.sources.scratch import materialize

CAPACITY = 2048
END_OF_DOCUMENT = 0
ENCODED_AT_ONCE = 200_000
#: Words of letters that are encoded as one text.
JOINED_WORDS = 1_000
WORD_END = "</w>"
#: Pieces of one length that are ranked together.
BUCKET_ROWS = 4_096
#: Strings whose ids a worker remembers, in each of two generations.
CACHED_STRINGS = 500_000

_STOPS = b".,"
#: A-Z as A, bytes of U+0300 and above as their first, others as 0.
_KINDS = bytes(65 if 65 <= c <= 90 else 0xCC if c >= 0xCC else 0 for c in range(256))


# ---- tokens ---------------------------------------------------------------


class WordTokens:
    """Ids (little-endian, 32 bits) of texts under a tokenizer that never joins across blanks.

    Such a tokenizer gives a text the ids of its blank-separated strings, one after
    the other, and lower-cases, so the ids of a lower-cased string are remembered.  It
    composes first, and what a letter of A-Z and a mark behind it compose to depends
    on the letter's case, so a string with such a pair keeps its case.  It
    also parts a letter from the full stop or comma behind it, so a word with one
    needs the word's ids only.  A text with ``<|`` may hold a special token, which
    counts case, and is encoded whole.

    Strings are remembered in two generations: when the young one is full it becomes
    the old one, and what is used again moves over.
    """

    def __init__(self, path: str, capacity: int = CACHED_STRINGS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        self.ends_word = np.array([name is not None and name.endswith(WORD_END) for name in names])
        self.capacity = capacity
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        ids = []
        for at in range(0, len(texts), ENCODED_AT_ONCE):  # an encoding is far larger than its ids
            found = self.tokenizer.encode_batch_fast(texts[at : at + ENCODED_AT_ONCE], add_special_tokens=False)
            ids += [array("I", x.ids).tobytes() for x in found]
        return ids

    def _word_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters, which are encoded many to a text: each ends with the next token that ends a word."""
        ids = []
        for at in range(0, len(words), ENCODED_AT_ONCE):
            parts = [words[i : i + JOINED_WORDS] for i in range(at, min(at + ENCODED_AT_ONCE, len(words)), JOINED_WORDS)]
            found = self.tokenizer.encode_batch_fast([b" ".join(p).decode() for p in parts], add_special_tokens=False)
            for part, one in zip(parts, found, strict=True):
                flat = np.array(one.ids, "<u4")
                ends = (4 * (np.flatnonzero(self.ends_word[flat]) + 1)).tolist()
                if len(ends) != len(part):  # a letter whose lower case is more than a letter
                    ids += self._ids([s.decode() for s in part])
                    continue
                raw = flat.tobytes()
                ids += [raw[first:end] for first, end in zip([0, *ends], ends, strict=False)]
        return ids

    def _learn(self, strings: set[bytes]) -> None:
        """Bring strings that are not there into the young generation."""
        young, old = self.young, self.old
        new = []
        for s in strings:
            if (ids := old.get(s)) is not None:
                young[s] = ids
            else:
                new.append(s)
        ended = [s for s in new if len(s) > 1 and s[-1] in _STOPS and 97 <= s[-2] <= 122]  # a-z
        rest = set(new).difference(ended)
        rest.update(core for s in ended if (core := s[:-1]) not in young)
        plain = [s for s in rest if s.isalpha() or _is_latin(s)]  # of bytes: A-Z, a-z
        young.update(zip(plain, self._word_ids(plain), strict=True))
        rest = list(rest.difference(plain))
        young.update(zip(rest, self._ids([s.decode() for s in rest]), strict=True))
        stops = dict(zip(_STOPS, self._ids([chr(c) for c in _STOPS]), strict=True))
        for s in ended:
            young[s] = young[s[:-1]] + stops[s[-1]]

    def forget(self) -> None:
        """Let all strings go; workers that wait for a task hold none."""
        self.young, self.old = {}, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.young) > self.capacity:
            self.old, self.young = self.young, {}
        usual = [i for i, t in enumerate(texts) if "<|" not in t and (t.isascii() or not _may_compose(t.encode()))]
        done: list[bytes | None] = [None] * len(texts)
        for i, ids in zip(usual, self._looked_up([texts[i] for i in usual]), strict=True):
            done[i] = ids
        for i, text in enumerate(texts):
            if done[i] is None and "<|" in text:
                done[i] = self._ids([text])[0]
            elif done[i] is None:
                strings = _strings(text)
                self._learn(set(strings).difference(self.young))
                done[i] = b"".join(map(self.young.__getitem__, strings))
        return done

    def _looked_up(self, texts: list[str]) -> list[bytes]:
        """Ids of texts whose strings have those of their lower case: each string is asked for once, Arrow knows where it stands."""
        split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
        strings = split.flatten().dictionary_encode()
        distinct = strings.dictionary.cast(pa.large_binary()).to_pylist()
        self.young[b""] = b""  # stands before and behind blanks at the ends
        self._learn(set(filterfalse(self.young.__contains__, distinct)))
        found = list(map(self.young.__getitem__, distinct))
        flat = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        code = strings.indices.to_numpy()
        first, many = (size.cumsum() - size)[code], size[code]
        end = many.cumsum()
        raw = flat[np.repeat(first - end + many, many) + np.arange(int(many.sum()))].tobytes()
        of_text = np.concatenate([[0], end])[split.offsets.to_numpy() - split.offsets[0].as_py()] * 4
        return [raw[a:b] for a, b in zip(of_text.tolist(), of_text[1:].tolist(), strict=False)]


def _is_latin(string: bytes) -> bool:
    """Are all characters letters below U+0250?  Nothing there composes with a letter or parts from one."""
    text = string.decode()
    return text.isalpha() and max(text) < "\u0250"


def _may_compose(data: bytes) -> bool:
    """Is a letter of A-Z followed by a character of U+0300 or above?  Those below compose with nothing before them."""
    return b"A\xcc" in data.translate(_KINDS)


def _strings(text: str) -> list[bytes]:
    """The blank-separated strings of a text, A-Z as a-z where the ids are the same."""
    data = text.encode()
    return [s if _may_compose(s) else s.lower() for s in data.split()]


def word_tokens(path: str) -> WordTokens:
    """The encoder of a vocabulary file; a worker loads it once."""
    loaded = worker_cache("tokens")
    if path not in loaded:
        loaded[path] = WordTokens(path)
    return loaded[path]


def _texts(column: pa.Array, size: int = 1 << 22) -> Iterator[list[str]]:
    """The texts in runs of some MB, null as empty."""
    run, held = [], 0
    for value in column:
        text = value.as_py() or ""
        run.append(text)
        held += len(text)
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = True,
    doc_id: str = "doc_id", text: str = "text", end: int = END_OF_DOCUMENT,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids): every document's ids and ``end``, cut where longer than ``capacity``.

    A null or empty text is ``end`` alone.  Repeated rows give pieces each; other
    columns are not read.  ``ids`` is binary, little-endian 32-bit; null without
    ``with_ids``.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    last = np.array([end], "<u4").tobytes()
    width = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(vocabulary)
        for batch in batches:
            done = 0
            for texts in _texts(batch.column(1)):
                at, piece, start, length, crc, kept = [], [], [], [], [], []
                for i, ids in enumerate(tokens.encode(texts), done):
                    ids += last
                    for n, first in enumerate(range(0, len(ids), width)):
                        part = ids[first : first + width]
                        at.append(i)
                        piece.append(n)
                        start.append(first // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        kept.append(part if with_ids else None)
                done += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                     pa.array(kept, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
        tokens.forget()

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        releasing(cut), f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, ids binary")


# ---- plan -----------------------------------------------------------------


@dataclass
class _Bins:
    """``count`` equal sequences with ``free`` tokens left; ``runs``: (length, how many, offset of the first)."""

    count: int
    free: int
    runs: list[tuple[int, int, int]] = field(default_factory=list)

    def with_run(self, count: int, length: int, many: int, capacity: int) -> _Bins:
        return _Bins(count, self.free - length * many, [*self.runs, (length, many, capacity - self.free)])


def best_fit(histogram: dict[int, int], capacity: int) -> list[_Bins]:
    """Best-fit decreasing over counts: longest first, each into the fullest sequence that has room."""
    open_: dict[int, list[_Bins]] = {}
    frees: list[int] = []
    closed: list[_Bins] = []

    def put(bins: _Bins) -> None:
        if bins.free == 0:
            closed.append(bins)
        elif bins.free in open_:
            open_[bins.free].append(bins)
        else:
            open_[bins.free] = [bins]
            bisect.insort(frees, bins.free)

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a length of {length} does not fit {capacity}")
        left, filled = histogram[length], []
        while left:
            at = bisect.bisect_left(frees, length)
            if at == len(frees):
                bins = _Bins(-(-left // (capacity // length)), capacity)
            else:
                bins = open_[frees[at]].pop()
                if not open_[bins.free]:
                    del open_[bins.free], frees[at]
            each = bins.free // length  # once in a sequence, it stays the fullest that has room
            full, more = divmod(min(left, each * bins.count), each)
            left -= full * each + more
            if full:
                filled.append(bins.with_run(full, length, each, capacity))
            if more:
                filled.append(bins.with_run(1, length, more, capacity))
            if full + (more > 0) < bins.count:
                put(_Bins(bins.count - full - (more > 0), bins.free, bins.runs))
        for bins in filled:
            put(bins)
    return closed + [bins for same in open_.values() for bins in same]


def slots(plan: list[_Bins]) -> np.ndarray:
    """Planned slots by (length, first rank): ranks from there on fill ``many`` places of each sequence in turn."""
    rows, sequence, taken = [], 0, {}
    for bins in plan:
        for length, many, offset in bins.runs:
            rank = taken.get(length, 0)
            rows.append((length, rank, sequence, many, offset))
            taken[length] = rank + many * bins.count
        sequence += bins.count
    kind = np.dtype([(name, np.int64) for name in ("length", "rank", "sequence", "many", "offset")])
    return np.sort(np.array(rows, kind), order=("length", "rank"))


def ranked(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """``pieces`` with ``rank``: 0, 1, ... within each length.

    A length is dealt into as many hash buckets as its count asks for.
    """
    most = max(histogram, default=0)
    buckets = [max(1, -(-histogram.get(length, 0) // BUCKET_ROWS)) for length in range(most + 1)]
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.get(F.lit(buckets), F.col("length").cast("int")))
    rows = pieces.withColumn("__bucket", bucket)
    counts = rows.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(
        F.col("length").alias("__length"), F.col("__bucket").alias("__of"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    within = Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = rows.withColumn("__within", F.row_number().over(within) - 1)
    joined = numbered.join(firsts, (F.col("length") == F.col("__length")) & (F.col("__bucket") == F.col("__of")))
    return joined.select(*pieces.columns, (F.col("__first") + F.col("__within")).alias("rank"))


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset.  Give a written table: it is read several times.

    Only the histogram of lengths, at most ``capacity`` rows, comes to the driver,
    and only the plan made of it is broadcast.  An empty table stays empty.
    """
    spark = pieces.sparkSession
    counted = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    histogram = {row.length: row.n for row in counted}
    plan = slots(best_fit(histogram, capacity))
    shared = spark.sparkContext.broadcast(plan)
    columns = pieces.columns

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        key = (plan["length"] << 48) + plan["rank"]  # no length has so many ranks
        for batch in batches:
            length, rank = (batch.column(columns.index("length")).to_numpy(), batch.column(len(columns)).to_numpy())
            found = plan[np.searchsorted(key, (length << 48) + rank, side="right") - 1]
            turn, place = np.divmod(rank - found["rank"], found["many"])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found["sequence"] + turn), pa.array(found["offset"] + place * length)],
                names=[*columns, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked(pieces, histogram).mapInArrow(placed, f"{kinds}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False, **columns
) -> DataFrame:
    """Tokenize, cut and pack ``docs``: the pieces with sequence_id and offset, gapless from 0 in each sequence."""
    pieces = token_pieces(docs, vocabulary, capacity, with_ids, **columns)
    pieces = materialize(pieces if with_ids else pieces.drop("ids"), "pack-pieces")
    return packed(pieces, capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the token ids of each sequence, from packed pieces with ids."""
    parts = placed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return parts.select("sequence_id", "length", joined.alias("ids"))

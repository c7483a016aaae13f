"""How the tokens of two vocabularies align, from inverted bitmaps of token pairs.

Two tokenizers cut the same bytes; where both have a token that ends at a byte, the two
tokens are linked.  A task aligns its documents in blocks.  For each pair of ids that a
block links, it keeps in which of the block's documents, and how often, as planes: plane
k is a compressed bitmap of the documents whose multiplicity has bit k.  The planes OR-ed
and popcounted are the pair's documents, the popcounts weighted by 2 ** k its links, and
both add up over blocks to the counts of the corpus.  The counts then go back the way
they came: a pair's postings tell each document how often it gets the pair's score.

A space before a word parts the tokens of both vocabularies, so texts are aligned word
by word, and words are remembered.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millwright.llm.text import releasing, worker_cache
from millwright.sources.scratch import materialize, scratch_tables

#: A block is closed at so many documents, or links if there are more in them.
BLOCK_DOCS = 4_096
BLOCK_LINKS = 3_000_000
#: Words that a worker remembers, and characters of texts that are aligned at once.
CACHED_WORDS = 300_000
RUN_CHARS = 1 << 20
#: A plane of more documents of a block is a bitmap, otherwise a list of 16-bit numbers.
LISTED = BLOCK_DOCS // 16
_BITMAP = 1 << 15

#: Blanks other than the space, of which a word may have none at its ends.
_OTHER_BLANK = re.compile(r"[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


# ---- tokens -----------------------------------------------------------------


def byte_symbols() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable characters stand for themselves, the other bytes for those from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def words(text: str) -> list[str]:
    """``text`` cut at single spaces between two characters that are no blanks; joined by spaces they are ``text``."""
    found = text.split(" ")
    if "" not in found and " \n" not in text and "\n " not in text and not _OTHER_BLANK.search(text):
        return found
    joined: list[str] = []
    open_ = False  # does what came before end in a blank?
    for i, word in enumerate(found):
        if i and (open_ or not word or word[0].isspace()):
            joined[-1] += " " + word
        else:
            joined.append(word)
        open_ = not word or word[-1].isspace()
    return joined


class Aligner:
    """Groups and links of words, each aligned once while it is remembered.

    Words are numbered; ``counts`` has a row (A tokens, B tokens, groups) for each, all
    -1 where the joined bytes of a vocabulary's tokens are not the word's.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        symbols, size = byte_symbols(), self.a.get_vocab_size()
        entries = (self.a.id_to_token(i) or "" for i in range(size))
        self.bytes_a = [
            bytes(symbols[c] for c in e) if all(c in symbols for c in e) else e.encode() for e in entries]
        pieces = ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        if max(size, len(self.bytes_b)) > 1 << 16:
            raise ValueError("postings name a pair by two ids of 16 bits")
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.told = [f"{i}{end}".encode() for i in range(size) for end in ",|"]
        self.told += [f"{i}{end}".encode() for i in range(len(self.bytes_b)) for end in ",;\n"]
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.counts = np.zeros((0, 3), np.int64)
        self.groups: list[bytes] = []
        self.pairs, self.ends = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, found: set[str]) -> None:
        new = list(found.difference(self.number))
        if not new:
            return
        counts, groups, pairs = self.align(new)
        self.number.update(zip(new, range(len(self.groups), len(self.groups) + len(new)), strict=True))
        self.counts = np.concatenate([self.counts, counts])
        self.groups += groups
        self.ends = np.concatenate([self.ends, np.maximum(counts[:, 2], 0).cumsum() + len(self.pairs)])
        self.pairs = np.concatenate([self.pairs, pairs])

    def align(self, found: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """(counts, groups as text, pairs of all words one after the other) of words, each behind a space."""
        raw = [b" " + w.encode() for w in found]
        ids_a = [x.ids for x in self.a.encode_batch_fast([" " + w for w in found], add_special_tokens=False)]
        ids_b = self.b.encode(found, num_threads=1)
        flat, counts, good = [], [], np.ones(len(found), bool)
        for ids, table in ((ids_a, self.bytes_a), (ids_b, self.bytes_b)):
            counts.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), np.int64, int(counts[-1].sum())))
            if b"".join(map(table.__getitem__, flat[-1].tolist())) != b"".join(raw):
                good &= [b"".join(map(table.__getitem__, x)) == r for x, r in zip(ids, raw, strict=True)]
        (a, b), (n_a, n_b) = flat, counts
        if not good.all():
            a, b, n_a, n_b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a * good, n_b * good
        ends_a, ends_b = self.sizes_a[a].cumsum(), self.sizes_b[b].cumsum()
        shared_a = np.isin(ends_a, ends_b, assume_unique=True)
        shared_b = np.isin(ends_b, ends_a, assume_unique=True)
        at_a, at_b = np.flatnonzero(shared_a), np.flatnonzero(shared_b)  # the last tokens of each group
        group_a, group_b = shared_a.cumsum() - shared_a, shared_b.cumsum() - shared_b
        # behind each group's A tokens its B tokens: what a token stands behind is its own place plus the other side's
        place_a = np.arange(len(a)) + np.concatenate([[0], at_b + 1])[group_a]
        place_b = np.arange(len(b)) + (at_a + 1)[group_b] if len(b) else np.zeros(0, np.int64)
        word_end = np.zeros(len(b), np.int64)
        word_end[n_b[good].cumsum() - 1] = 1
        codes = np.zeros(len(a) + len(b), np.int64)
        codes[place_a] = 2 * a + shared_a
        codes[place_b] = 2 * len(self.bytes_a) + 3 * b + shared_b + word_end
        lines = iter(b"".join(map(self.told.__getitem__, codes.tolist())).split(b"\n"))
        groups = [next(lines) if g else b"" for g in good]
        n_groups = np.zeros(len(found), np.int64)
        word_of = np.repeat(np.arange(len(found)), n_a)[at_a]
        np.add.at(n_groups, word_of, 1)
        told = np.where(good[:, None], np.stack([n_a, n_b, n_groups], axis=1), -1)
        return told, groups, a[at_a] << 16 | b[at_b]


def _aligner(path_a: str, path_b: str) -> Aligner:
    loaded = worker_cache("aligners")
    if (path_a, path_b) not in loaded:
        loaded[path_a, path_b] = Aligner(path_a, path_b)
    return loaded[path_a, path_b]


class Aligned:
    """Some texts: per text the counts and the digest of its groups; ``text`` and ``pair`` of every link."""

    def __init__(self, aligner: Aligner, texts: list[str]):
        cut = [words(t) if t else [] for t in texts]
        aligner.learn(set(chain.from_iterable(cut)))
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        number = np.fromiter(map(aligner.number.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        of = np.repeat(np.arange(len(cut)), sizes)
        counts = aligner.counts[number]
        odd = np.unique(of[counts[:, 0] < 0])
        whole = {int(i): aligner.align([texts[i]]) for i in odd}  # a word alone may only seem to differ
        stays = ~np.isin(of, odd)
        number, of, counts = number[stays], of[stays], counts[stays]
        self.counts = np.zeros((len(texts), 3), np.int64)
        for k in range(3):
            self.counts[:, k] = np.bincount(of, weights=counts[:, k], minlength=len(texts)).astype(np.int64)
        first = np.concatenate([[0], aligner.ends])[number]
        links = counts[:, 2]
        before = links.cumsum() - links
        self.pair = aligner.pairs[np.repeat(first - before, links) + np.arange(int(links.sum()))]
        self.text = np.repeat(of, links)
        group = aligner.groups.__getitem__
        told, at = number.tolist(), 0
        self.sha256 = []
        for i, n in enumerate(sizes.tolist()):
            if i in whole:
                (found,), (line,), pairs = whole[i]
                if found[0] < 0:
                    self.sha256.append("")
                    continue
                self.counts[i] = found
                self.pair, self.text = np.concatenate([self.pair, pairs]), np.concatenate([self.text, np.full(len(pairs), i)])
                self.sha256.append(hashlib.sha256(line).hexdigest())
            else:
                line = b";".join(map(group, told[at : at + n]))
                self.sha256.append(hashlib.sha256(line).hexdigest() if n else "")
                at += n


# ---- postings ---------------------------------------------------------------


def packed(pair: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, documents, links, postings, where each ends) from the links of a block; ``doc`` counts from 0 in it.

    A pair's postings are its planes: a number of the plane, how many documents, and
    these, in numbers of 16 bits: listed, or as a bitmap with the highest bit of the
    plane's number set.
    """
    key, many = np.unique(pair << 16 | doc, return_counts=True)
    pair, doc = key >> 16, key & 0xFFFF
    pairs, first = np.unique(pair, return_index=True)
    of = np.repeat(np.arange(len(pairs)), np.diff([*first, len(pair)]))
    planes = []
    for k in range(int(many.max(initial=0)).bit_length()):
        has = np.flatnonzero(many >> k & 1)
        planes.append((of[has], np.full(len(has), k), doc[has]))
    of, plane, doc = (np.concatenate(x) if planes else np.zeros(0, np.int64) for x in (zip(*planes, strict=True) if planes else [[]] * 3))
    order = np.lexsort((doc, plane, of))
    of, plane, doc = of[order], plane[order], doc[order]
    starts = np.flatnonzero(np.diff(of << 8 | plane, prepend=-1))
    card = np.diff([*starts, len(of)])
    bitmap = card > LISTED
    size = 2 + np.where(bitmap, BLOCK_DOCS // 16, card)
    end = size.cumsum()
    begin = end - size
    out = np.zeros(int(size.sum()), "<u2")
    out[begin] = plane[starts] + bitmap * _BITMAP
    out[begin + 1] = card
    run = np.repeat(np.arange(len(starts)), card)
    listed = ~bitmap[run]
    rank = np.arange(len(run)) - starts[run]
    out[begin[run[listed]] + 2 + rank[listed]] = doc[listed]
    dense, bit = run[~listed], doc[~listed]
    np.bitwise_or.at(out, begin[dense] + 2 + (bit >> 4), (1 << (bit & 15)).astype("<u2"))
    links = np.zeros(len(pairs), np.int64)
    np.add.at(links, of[starts], card << plane[starts])
    last = np.zeros(len(pairs), np.int64)
    last[of[starts]] = end  # planes ascend, the last one's end stays
    return pairs, np.diff([*first, len(key)]), links, out, last


def unpacked(postings: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(row, plane, document) arrays of the postings at ``begin`` to ``end``, a plane of every row at a time."""
    row, at = np.arange(len(begin)), begin.copy()
    while len(row):
        open_ = at < end[row]
        row, at = row[open_], at[open_]
        head, card = postings[at].astype(np.int64), postings[at + 1].astype(np.int64)
        plane, bitmap = head & (_BITMAP - 1), head >= _BITMAP
        listed = np.where(bitmap, 0, card)
        rank = np.arange(int(listed.sum())) - np.repeat(listed.cumsum() - listed, listed)
        yield np.repeat(row, listed), np.repeat(plane, listed), postings[np.repeat(at + 2, listed) + rank].astype(np.int64)
        dense = np.flatnonzero(bitmap)
        for some in np.array_split(dense, -(-len(dense) // 1_000) or 1):
            taken = np.ascontiguousarray(postings[at[some][:, None] + 2 + np.arange(BLOCK_DOCS // 16)])
            which, doc = np.nonzero(np.unpackbits(taken.view(np.uint8), axis=1, bitorder="little"))
            yield row[some][which], plane[some][which], doc
        at = at + 2 + np.where(bitmap, BLOCK_DOCS // 16, card)


# ---- tables -----------------------------------------------------------------

_DOCS = "block long, at int, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_POSTINGS = "a int, b int, n_docs long, pair_links long, postings binary"


def _arrow(kinds: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(kinds))


def _runs(column: pa.Array) -> Iterator[list[str]]:
    """The texts in runs of about ``RUN_CHARS``, null as empty."""
    run, held = [], 0
    for value in column:
        run.append(value.as_py() or "")
        held += len(run[-1])
        if held >= RUN_CHARS or len(run) == BLOCK_DOCS:
            yield run
            run, held = [], 0
    if run:
        yield run


class _Block:
    """Links of the documents of a block that is not yet closed."""

    def __init__(self, number: int):
        self.number, self.docs, self.links, self.parts = number, 0, 0, []

    def add(self, done: Aligned, first: int, end: int, links: slice) -> None:
        self.parts.append((done.pair[links], done.text[links] - first + self.docs))
        self.docs += end - first
        self.links += links.stop - links.start

    def batch(self) -> pa.RecordBatch:
        pairs, n_docs, n_links, out, last = packed(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))
        offsets = np.concatenate([[0], 2 * last]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(pairs), self.number)), pa.array((pairs >> 16).astype(np.int32)),
             pa.array((pairs & 0xFFFF).astype(np.int32)), pa.array(n_docs), pa.array(n_links),
             pa.Array.from_buffers(pa.binary(), len(pairs), [None, pa.py_buffer(offsets), pa.py_buffer(out)])],
            names=["block", "a", "b", "n_docs", "pair_links", "postings"])


def _aligned_blocks(path_a: str, path_b: str, schema: pa.Schema):
    def full(**columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)

    def closed(block: _Block) -> Iterator[pa.RecordBatch]:
        if block.links:
            batch = block.batch()
            for at in range(0, batch.num_rows, 50_000):
                part = batch.slice(at, 50_000)
                yield full(**dict(zip(part.schema.names, part.columns, strict=True)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        block = _Block(TaskContext.get().partitionId() << 32)
        for batch in batches:
            start = 0
            for texts in _runs(batch.column(1)):
                done = Aligned(aligner, texts)
                order = np.argsort(done.text, kind="stable")
                done.pair, done.text = done.pair[order], done.text[order]
                ends = np.searchsorted(done.text, np.arange(len(texts)), side="right")
                numbers, places, first = [], [], 0
                for i in range(len(texts)):  # a block ends between two documents
                    numbers.append(block.number)
                    places.append(block.docs + i - first)
                    begin = int(ends[first - 1]) if first else 0
                    links = int(ends[i]) - begin
                    if i + 1 == len(texts) or block.docs + i + 1 - first >= BLOCK_DOCS or block.links + links >= BLOCK_LINKS:
                        block.add(done, first, i + 1, slice(begin, int(ends[i])))
                        first = i + 1
                        if block.docs >= BLOCK_DOCS or block.links >= BLOCK_LINKS:
                            yield from closed(block)
                            block = _Block(block.number + 1)
                n_a, n_b, n_groups = done.counts.T
                yield full(
                    block=pa.array(numbers, pa.int64()), at=pa.array(places, pa.int32()),
                    doc_id=batch.column(0).slice(start, len(texts)), n_a=pa.array(n_a), n_b=pa.array(n_b),
                    n_groups=pa.array(n_groups), n_links=pa.array(np.bincount(done.text, minlength=len(texts))),
                    groups_sha256=pa.array(done.sha256))
                start += len(texts)
                if len(aligner.number) > CACHED_WORDS:
                    aligner.forget()
        yield from closed(block)

    return work


def _returned(schema: pa.Schema):
    """The documents of a block with what the block's postings, which know their pairs' scores, give them."""

    def work(docs: pa.Table, scored: pa.Table) -> pa.Table:
        size = BLOCK_DOCS
        best, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in scored.select(["postings", "score", "best"]).to_batches():
            column = batch.column(0)
            if not len(column):
                continue
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] // 2
            data = np.frombuffer(column.buffers()[2], "<u2")
            score, is_best = batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            for row, plane, doc in unpacked(data, offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)):
                np.add.at(total, doc, score[row] << plane)
                np.add.at(best, doc, is_best[row].astype(np.int64) << plane)
        at = docs.column("at").to_numpy()
        columns = {name: docs.column(name) for name in docs.column_names}
        columns |= {"n_best": pa.array(best[at]), "count_sum": pa.array(total[at])}
        return pa.Table.from_arrays([columns[f.name] for f in schema], schema=schema)

    return work


def pair_counts(postings: DataFrame) -> DataFrame:
    """(a, b, n_docs, pair_links): documents and links of every pair of ids, from all blocks' postings."""
    return postings.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("pair_links").alias("pair_links"))


def align_tokens(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row per row.

    A is a byte-level vocabulary of ``tokenizers`` and gets a space before the text, B a
    model of ``sentencepiece`` that adds one.  Strings of special tokens are plain text.
    Groups are cut where tokens of both end at a byte; each such end is a link.  A pair
    of ids counts as often as it is linked in all documents: ``count_sum`` adds the
    counts of a document's links, ``n_best`` are its links with the highest count that
    their B id has, ties included.

    A null or empty text, or one that a vocabulary does not give back byte by byte, has
    no tokens: zeros and an empty digest.  Texts are read whole, words of any length
    too; a document is the unit that no block divides.  Repeated rows are rows of their
    own and count each; ids are of any type, null too; other columns are not read.  An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType.simpleString()
    kinds = f"{_DOCS.format(id=id_type)}, {_POSTINGS}"
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    with scratch_tables(spark) as tables:
        blocks = tables.write(
            rows.mapInArrow(releasing(_aligned_blocks(path_a, path_b, _arrow(kinds))), kinds), "aligned-blocks")
        postings = blocks.where("a is not null").select("block", "a", "b", "n_docs", "pair_links", "postings")
        counts = tables.write(pair_counts(postings), "aligned-pairs")
        most = counts.groupBy("b").agg(F.max("pair_links").alias("__most"))
        scores = counts.join(most, "b").select(
            "a", "b", F.col("pair_links").alias("score"), (F.col("pair_links") == F.col("__most")).alias("best"))
        scored = postings.join(scores, ["a", "b"]).select(F.col("block").alias("of"), "postings", "score", "best")
        told = blocks.where("a is null").select("block", "at", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
        done = told.groupBy("block").cogroup(scored.groupBy("of")).applyInArrow(_returned(_arrow(out)), out)
        return materialize(done, "aligned")

"""MinHash near-dedup on HyperMinHash sketches.

A document is its set of word shingles.  Equal sets are one class, and only the
class's smallest id goes on.  Its sketch has a register per bucket: the leading
zeros of the bucket's smallest hash value and the mantissa bits after them, 16 bits
in all.  A large set deals its shingles to the buckets, as HyperMinHash does; a
small set, which would leave buckets empty, puts every shingle into every bucket
under another multiplier.  Sizes near the border get both sketches, so that two
sets that may be linked always share one kind.

Four registers are a band, and classes that agree in a band are candidates.  Each
band's group has a hub, its smallest id, and the others are compared with it; those
that are linked become one component.  What is left are pairs between components of
a group.  They are compared in blocks of members, inside a task, where only links
that join components come out; nothing that could join two is left out.  A pair's
Jaccard similarity is first estimated from the registers, corrected for registers
that agree by chance; only what is within five standard deviations of the threshold
goes on, and is decided on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.components import components
from millwright.llm.text import releasing
from millwright.sources.scratch import Scratch, in_few_files, materialize, scratch_tables

SHINGLE_WORDS = 5
#: A link: intersection * 100 >= union * PERCENT.
PERCENT = 75
REGISTERS = 128
BAND = 4
MANTISSA = 10
EMPTY = 0xFFFF
#: Sets of at least so many shingles are dealt to the buckets (one bucket of 128 in 3,000 stays empty).
DEALT_FROM = 1024
DEVIATIONS = 5
LEAST_ESTIMATE = PERCENT / 100 - DEVIATIONS * (PERCENT / 100 * (1 - PERCENT / 100) / REGISTERS) ** 0.5
#: Members compared with one copy of a hub's sketch or set.
MEMBERS_PER_HUB = 512
#: Members of a block of an open group.
BLOCK_MEMBERS = 256
CACHED_WORDS = 200_000
_MULTIPLIERS = np.random.default_rng(20240229).integers(1 << 62, 1 << 63, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)


# ---- sets and sketches ----------------------------------------------------


def _word_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    if len(known) > CACHED_WORDS:
        known.clear()
    try:
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        known.update((w, xxhash.xxh3_64_intdigest(w)) for w in set(words).difference(known))
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingle_set(text: bytes, size: int = SHINGLE_WORDS, known: dict[bytes, int] | None = None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; fewer words than ``size`` are one shingle.

    ``known`` remembers the hashes of words from text to text.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = _word_hashes(words, {} if known is None else known)
    size = min(size, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for i in range(size):
        h = _mixed(h ^ w[i : len(w) - size + 1 + i])
    return np.unique(h)


def _registers(least: np.ndarray) -> np.ndarray:
    """Leading zeros (6 bits) and mantissa (10 bits) of the smallest values."""
    bits = np.maximum(least, np.uint64(1)).astype(np.float64).view(np.uint64)
    zeros = np.clip(63 + 1023 - (bits >> np.uint64(52)).astype(np.int64), 0, 62)
    mantissa = (bits >> np.uint64(52 - MANTISSA)).astype(np.int64) & ((1 << MANTISSA) - 1)
    return (zeros << MANTISSA | mantissa).astype(np.uint16)


def small_sketch(values: np.ndarray) -> np.ndarray:
    """Every shingle in every bucket, under the bucket's multiplier."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 1024):
        np.minimum(least, np.multiply.outer(_MULTIPLIERS, values[at : at + 1024]).min(axis=1), out=least)
    return _registers(least)


def dealt_sketch(values: np.ndarray) -> np.ndarray:
    """The leading bits name a shingle's bucket, the others are its value there."""
    width = np.uint64(REGISTERS.bit_length() - 1)
    first = np.searchsorted(values, np.arange(REGISTERS, dtype=np.uint64) << (np.uint64(64) - width))
    bucket = values >> (np.uint64(64) - width)
    there = np.append(first[1:], len(values)) > first
    sketch = np.full(REGISTERS, EMPTY, np.uint16)
    at = first[there]
    sketch[bucket[at].astype(np.int64)] = _registers(values[at] << width)
    return sketch


def _sketches(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, digest, small, dealt) of every row."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            sizes, digests, small, dealt = [], [], [], []
            for value in batch.column(1):
                found = shingle_set((value.as_py() or "").encode(), known=known)
                n = len(found)
                sizes.append(n)
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if n else None)
                small.append(small_sketch(found).tobytes() if 0 < n <= DEALT_FROM * 100 // PERCENT else None)
                dealt.append(dealt_sketch(found).tobytes() if n >= DEALT_FROM else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), *(pa.array(x, pa.binary()) for x in (digests, small, dealt))],
                names=["doc_id", "n_shingles", "digest", "small", "dealt"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(releasing(sketched), "doc_id long, n_shingles long, digest binary, small binary, dealt binary")


def _bands(classes: DataFrame) -> DataFrame:
    """(bucket, id): the bands of a class's sketches, each hashed with its number and kind."""

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = REGISTERS // BAND
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for kind in (0, 1):
                column = batch.column(1 + kind)
                at = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
                if not len(at):
                    continue
                raw = np.frombuffer(b"".join(column.drop_null().to_pylist()), np.uint64).reshape(-1, n)
                number = np.arange(n, dtype=np.uint64) + np.uint64(1 + kind * n)
                bucket = _mixed(_mixed(raw) ^ _mixed(number)[None, :])
                full = raw != np.iinfo(np.uint64).max  # a band of empty buckets says nothing
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[full].view(np.int64)), pa.array(np.repeat(ids[at], n)[full.ravel()])],
                    names=["bucket", "id"])

    return classes.select("id", "small", "dealt").mapInArrow(releasing(banded), "bucket long, id long")


# ---- pairs ----------------------------------------------------------------


def _levels(n: np.ndarray, buckets: int) -> np.ndarray:
    """How likely the smallest of each number of values has 0, 1, ... leading zeros."""
    level = np.arange(63)
    k = np.maximum(np.asarray(n) / buckets, 1.0)[:, None]
    return (1 - 0.5 ** (level + 1)) ** k - (1 - 0.5**level) ** k


def _chance(n: np.ndarray, m: np.ndarray, buckets: int) -> np.ndarray:
    """How likely a register of independent sets of n and m shingles agrees by chance, for all pairs."""
    return _levels(n, buckets) @ _levels(m, buckets).T / (1 << MANTISSA)


def estimated_jaccard(a: np.ndarray, b: np.ndarray, n: int, m: int, buckets: int = 1) -> float:
    """From the share of registers that agree, less what agrees by chance; both empty say nothing."""
    used = (a != EMPTY) | (b != EMPTY)
    agree = np.count_nonzero((a == b) & used) / max(1, np.count_nonzero(used))
    chance = float(_chance([n], [m], buckets)[0, 0])
    return max(0.0, (agree - chance) / (1 - chance))


def _may_link(hub: tuple, member: tuple) -> bool:
    """Whether the estimate is not far below the threshold for one kind of sketch that both have."""
    (n, *hub_kinds), (m, *member_kinds) = hub, member
    if min(n, m) * 100 < max(n, m) * PERCENT:
        return False
    for kind, (a, b) in enumerate(zip(hub_kinds, member_kinds, strict=True)):
        if a is not None and b is not None:
            a, b = np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16)
            if estimated_jaccard(a, b, n, m, REGISTERS if kind else 1) >= LEAST_ESTIMATE:
                return True
    return False


def _linked(hub: tuple, member: tuple) -> bool:
    """Whether the full sets are similar enough."""
    a, b = np.frombuffer(hub[0], np.uint64), np.frombuffer(member[0], np.uint64)
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = np.count_nonzero(large[at] == small)
    return bool(both * 100 >= PERCENT * (len(a) + len(b) - both))


def _chosen(
    pairs: DataFrame, payload: DataFrame, test: Callable[[tuple, tuple], bool], tables: Scratch, most: int
) -> DataFrame:
    """The (a, b) of ``pairs``, ``most`` of them or fewer, for which ``test`` of their payloads holds.

    ``a`` is a hub: its payload goes once to each block of its members, streamed
    before them, so a task holds one hub at a time however many members there are.
    """
    columns = [c for c in payload.columns if c != "id"]
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS_PER_HUB).alias("blocks")).withColumnRenamed("a", "hub")
    dealt = pairs.join(sizes, F.col("a") == F.col("hub")).select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block"))
    dealt = tables.write(in_few_files(dealt, most), "near-dealt")
    members = dealt.join(payload, F.col("b") == F.col("id")).select("a", "block", "b", *columns)
    hubs = dealt.select("a", "block").distinct().join(payload, F.col("a") == F.col("id")).select(
        "a", "block", F.lit(None).cast("long").alias("b"), *columns)
    rows = members.union(hubs).repartition("a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, hub = None, []
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            payloads = zip(*(batch.column(i) for i in range(3, 3 + len(columns))), strict=True)
            found = []
            for key, b, values in zip(keys, batch.column(2).to_pylist(), payloads, strict=True):
                value = tuple(v.as_py() for v in values)
                if key != group:
                    group, hub = key, []
                if b is None:
                    hub.append(value)
                elif any(test(h, value) for h in hub):
                    found.append((key[0], b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(releasing(choose), "a long, b long")


def _first_pairs(members: DataFrame) -> DataFrame:
    """A group's members against its smallest id."""
    hubs = members.groupBy("bucket").agg(F.min("id").alias("a"))
    return members.join(hubs, "bucket").where("a != id").select("a", F.col("id").alias("b")).distinct()


# ---- groups that have more than one component ---------------------------------


def _open_blocks(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, i, k, id, comp): which blocks of an open group's members are compared.

    A group's largest component is its main one.  The other members are dealt to
    minor blocks, numbered first, and the main ones to blocks after them; block i, a
    minor one, is compared with itself and every later block k.  So the members of
    the main component go out once per minor block and never meet each other.
    """
    known = members.join(labels, F.col("id") == F.col("node"), "left").select(
        "bucket", "id", F.coalesce("root", "id").alias("comp"))
    sizes = known.groupBy("bucket", "comp").agg(F.count("*").alias("size"))
    groups = sizes.groupBy("bucket").agg(
        F.count("*").alias("comps"), F.max_by("comp", F.struct("size", "comp")).alias("main"),
        F.max("size").alias("main_size"), F.sum("size").alias("all_size")).where("comps > 1")
    blocks = lambda size: F.ceil(size / BLOCK_MEMBERS).cast("int")
    groups = groups.select(
        F.col("bucket").alias("__group"), "main", blocks(F.col("all_size") - F.col("main_size")).alias("minors"),
        blocks(F.col("main_size")).alias("mains"))
    placed = known.join(groups, F.col("bucket") == F.col("__group")).withColumn("is_main", F.col("comp") == F.col("main"))
    dealt = F.when(F.col("is_main"), F.col("minors") + F.pmod(F.xxhash64("id"), "mains")).otherwise(
        F.pmod(F.xxhash64("id"), "minors")).cast("int")
    pair = lambda i, k: F.struct(i.cast("int").alias("i"), k.cast("int").alias("k"))
    block = F.col("block")
    before = F.transform(F.sequence(F.lit(0), F.col("minors") - 1), lambda i: pair(i, block))
    earlier = F.filter(before, lambda p: p["i"] < block)
    onward = F.transform(F.sequence(block, F.col("minors") + F.col("mains") - 1), lambda k: pair(block, k))
    pairs = F.when(F.col("is_main"), before).otherwise(F.concat(earlier, onward))
    return placed.withColumn("block", dealt).select("bucket", "id", "comp", F.inline(pairs))


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows in runs of equal leading columns, from batches that are sorted by them."""
    key, rows = None, []
    for batch in batches:
        heads = zip(*(batch.column(i).to_pylist() for i in range(keys)), strict=True)
        tails = zip(*(batch.column(i) for i in range(keys, batch.num_columns)), strict=True)
        for head, tail in zip(heads, tails, strict=True):
            if head != key:
                if rows:
                    yield key, rows
                key, rows = head, []
            rows.append(tuple(value.as_py() for value in tail))
    if rows:
        yield key, rows


def _in_blocks(rows: DataFrame, payload: DataFrame, work: Callable, schema: str, fields: list[str]) -> DataFrame:
    """``work`` on the rows of each (bucket, i, k) with their payload; it gives tuples of ``fields``."""
    columns = [c for c in payload.columns if c != "id"]
    held = rows.join(payload.withColumnRenamed("id", "__id"), F.col("id") == F.col("__id"))
    dealt = held.select("bucket", "i", "k", "id", "comp", *columns).repartition("bucket", "i", "k").sortWithinPartitions(
        "bucket", "i", "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for key, group in _grouped(batches, 3):
            found += work(key, group)
            if len(found) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=fields)
                found = []
        columns = list(zip(*found, strict=True)) or [()] * len(fields)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=fields)

    return dealt.mapInArrow(releasing(run), schema)


def _likely(key: tuple, group: list[tuple]) -> list[tuple]:
    """The members that, by their sketches, may be linked with one of another component."""
    comp = np.array([row[1] for row in group])
    n = np.array([row[2] for row in group])
    near = np.zeros((len(group), len(group)), bool)
    for kind, buckets in ((3, 1), (4, REGISTERS)):
        at = np.flatnonzero([row[kind] is not None for row in group])
        if len(at) > 1:
            registers = np.frombuffer(b"".join(group[i][kind] for i in at), np.uint16).reshape(-1, REGISTERS)
            agree = np.zeros((len(at), len(at)), np.int32)
            used = np.zeros((len(at), len(at)), np.int32)
            for column in registers.T:
                there = (column != EMPTY)[:, None] | (column != EMPTY)
                used += there
                agree += (column[:, None] == column) & there
            chance = _chance(n[at], n[at], buckets)
            near[np.ix_(at, at)] |= (agree / np.maximum(used, 1) - chance) / (1 - chance) >= LEAST_ESTIMATE
    near &= comp[:, None] != comp
    near &= np.minimum(n[:, None], n) * 100 >= np.maximum(n[:, None], n) * PERCENT
    return [(*key, group[i][0], group[i][1]) for i in np.flatnonzero(near.any(axis=1))]


def _joining(key: tuple, group: list[tuple]) -> list[tuple]:
    """Links on the full sets between components, no more than it takes to join them."""
    sets = [np.frombuffer(row[2], np.uint64) for row in group]
    n = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    value, place, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = holders > 1
    column = np.cumsum(shared) - 1
    kept = shared[place]
    owner, place = owner[kept], column[place[kept]]
    both = np.zeros((len(sets), len(sets)), np.int64)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for first in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(place, [first, first + 4096])
        held = np.zeros((len(sets), 4096), np.float32)
        held[owner[a:b], place[a:b] - first] = 1
        both += (held @ held.T).astype(np.int64)  # up to 4096 each, which is exact
    linked = both * 100 >= PERCENT * (n[:, None] + n - both)
    root = {row[1]: row[1] for row in group}

    def find(comp: int) -> int:
        while root[comp] != comp:
            root[comp] = comp = root[root[comp]]
        return comp

    found = []
    for x, y in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
        a, b = find(group[x][1]), find(group[y][1])
        if a != b:
            root[max(a, b)] = min(a, b)
            found.append((group[x][0], group[y][0]))
    return found


def _sets(docs: DataFrame, members: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, shingles) of the members' documents."""

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            found = [shingle_set((value.as_py() or "").encode(), known=known).tobytes() for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["id", "shingles"])

    ids = members.select(F.col("id").alias("__member")).distinct()
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.join(ids, F.col("id") == F.col("__member"), "left_semi").mapInArrow(releasing(computed), "id long, shingles binary")


def _linked_classes(
    docs: DataFrame, classes: DataFrame, n_classes: int, doc_id: str, text: str, tables: Scratch
) -> DataFrame | None:
    """(node, root) of the classes that are linked to smaller ones; None if there are no candidates."""
    bands = _bands(classes)
    shared = bands.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    members = bands.join(shared.select("bucket"), "bucket", "left_semi").distinct()
    members = tables.write(in_few_files(members, n_classes * (REGISTERS // BAND)), "near-members")
    most = members.count()  # a member is in a pair with its hub
    if not most:
        return None
    sketches = classes.select("id", "n_shingles", "small", "dealt")
    sets = tables.write(_sets(docs, members, doc_id, text), "near-sets")
    likely = _chosen(_first_pairs(members), sketches, _may_link, tables, most)
    labels = tables.write(components(_chosen(likely, sets, _linked, tables, most), tables, most=most), "near-labels")
    blocks = _open_blocks(members, labels)
    likely = _in_blocks(blocks, sketches, _likely, "bucket long, i long, k long, id long, comp long",
                        ["bucket", "i", "k", "id", "comp"])
    joining = _in_blocks(likely, sets, _joining, "a long, b long", ["a", "b"])
    known = labels.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return components(known.union(joining), tables)


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id, kept.

    Words are runs without ASCII blanks, A-Z as a-z.  ``component_id`` is the
    smallest id that links lead to.  A text without words, null or empty, has no
    shingles and is linked with nothing, and so is a row without an id, whose
    ``component_id`` is null and which is kept.  Repeated rows have the same
    component.  Texts of any length are read whole, and the set of one is the least
    that a task holds.  Ids are whole numbers.  Other columns are not read.
    """
    rows = materialize(_sketches(docs, doc_id, text), "near-sketches")
    n_rows = rows.count()
    classes = rows.where("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"),
        F.first("small").alias("small"), F.first("dealt").alias("dealt"))
    with scratch_tables(docs.sparkSession) as tables:
        classes = tables.write(in_few_files(classes, n_rows), "near-classes")
        labels = _linked_classes(docs, classes, n_rows, doc_id, text, tables)
        roots = classes.select(F.col("digest").alias("__digest"), F.col("id").alias("__root"))
        if labels is not None:
            roots = roots.join(labels, F.col("__root") == F.col("node"), "left").select(
                "__digest", F.coalesce("root", "__root").alias("__root"))
        roots = materialize(in_few_files(roots, n_rows), "near-roots")
    found = rows.select("doc_id", "n_shingles", "digest").join(
        roots, F.col("digest") == F.col("__digest"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("__root", "doc_id"))
    return in_few_files(found, n_rows).select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame | None:
    """``docs`` with __name: a number for each (id, text), in the order of ids; None if no id has several texts."""
    digest = F.coalesce(F.md5(F.col(text)), F.lit(""))  # a null text is none of the empty ones
    keys = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("__key"), digest.alias("__digest"))
    several = keys.groupBy("__key").agg(F.min("__digest").alias("lo"), F.max("__digest").alias("hi")).where("lo < hi")
    if several.isEmpty():
        return None
    names = keys.distinct().orderBy("__key", "__digest").withColumn("__name", F.monotonically_increasing_id())
    names = materialize(names, "near-names")
    found = docs.join(names, (F.col(doc_id) == F.col("__key")) & (digest == F.col("__digest")))
    return materialize(found.drop("__key", "__digest"), "near-named")


def without_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component; of repeated rows of its id and text, one.

    Rows of one id and different texts are documents of their own.  Of repeated rows
    that differ in other columns, the one whose columns come first as JSON stays.
    Rows without an id stay.
    """
    named = _named(docs, doc_id, text)
    rows, name = (docs.where(F.col(doc_id).isNotNull()), doc_id) if named is None else (named, "__name")
    kept = materialize(near_dedup(rows, name, text).where("kept").select(F.col("doc_id").alias("__kept")), "near-kept")
    stay = rows.join(kept, F.col(name) == F.col("__kept"), "left_semi")
    others = [F.col(c) for c in docs.columns if c not in (doc_id, text)]
    order = F.to_json(F.struct(*others)) if others else F.lit("")
    one = stay.groupBy(F.col(name).alias("__one")).agg(F.min_by(F.struct(*docs.columns), order).alias("__row"))
    return one.select("__row.*").unionByName(docs.where(F.col(doc_id).isNull()))

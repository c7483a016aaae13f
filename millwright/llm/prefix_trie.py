"""The prefix trie of conversations, built as z-fast tries and put together by digest.

A turn is named by a digest of its role and text, and a prefix by a digest of the
prefix before it and its last turn, so a conversation is a run of 16 bytes per depth.
Each task holds the z-fast trie of one batch of conversations: compacted nodes are
hashed at the two-fattest depth of their edge, which lets a binary search over depths
that takes the two-fattest depth in each step end at a new conversation's exit node.
A full trie's edges are expanded to a row per depth, which brings the conversations
of a batch with a common prefix to one row each depth; rows of equal digest are then
one node.

What the subtrees add up needs no step per level.  A node belongs to its smallest
member, so the nodes fall into one vertical path per conversation that brought any, and
only paths hang on paths: their totals are added by doubling the distance to the
ancestor, in as many rounds as the height of paths has binary digits.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.text import releasing
from millwright.sources.scratch import Scratch, materialize, scratch_tables

#: Bytes of a prefix's digest; the root's are all 0.
WIDTH = 16
ROOT = bytes(WIDTH)
#: Conversations are rebuilt in blocks of so many ids, with up to this many turns of the block's first.
BLOCK = 5
MOST_SHARED = 9
#: Turns of the conversations that a task's trie holds before its edges are expanded.
TRIE_TURNS = 200_000


# ---- one trie ---------------------------------------------------------------


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the highest power of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


def prefix(path: bytes, depth: int) -> bytes:
    """The digest at a depth of 1 or more; empty beyond the end."""
    return path[WIDTH * (depth - 1) : WIDTH * depth]


@dataclass
class Node:
    """A compacted node: the edge from depth ``above`` to ``depth``, read off one conversation that passes it."""

    above: int
    depth: int
    path: bytes
    sizes: list[int]
    children: dict[bytes, Node] = field(default_factory=dict)
    ends: list[int] = field(default_factory=list)

    def at(self, depth: int) -> bytes:
        return prefix(self.path, depth) if depth else ROOT

    def handle(self) -> bytes:
        return self.at(two_fattest(self.above, self.depth))


class ZFastTrie:
    """Conversations as runs of prefix digests; ids come in ascending order."""

    def __init__(self):
        self.root = Node(0, 0, b"", [])
        self.handles: dict[bytes, Node] = {}
        self.turns = 0

    def locate(self, path: bytes) -> tuple[Node, Node | None, int]:
        """(lowest node that is wholly on ``path``, the child whose edge it leaves, depth of the exit).

        The child is None where ``path`` leaves at the node itself.
        """
        node, low, high = self.root, 0, len(path) // WIDTH
        while low < high:
            depth = two_fattest(low, high)
            found = self.handles.get(prefix(path, depth))
            if found is not None and found.at(found.depth) == prefix(path, found.depth):
                node, low = found, found.depth
            else:
                high = depth - 1
        child = node.children.get(prefix(path, low + 1))
        if child is None:
            return node, None, low
        low, high = low + 1, min(child.depth, len(path) // WIDTH)  # they agree at low
        while low < high:
            middle = (low + high + 1) // 2
            if child.at(middle) == prefix(path, middle):
                low = middle
            else:
                high = middle - 1
        return node, child, low

    def insert(self, conv_id: int, path: bytes, sizes: list[int]) -> None:
        """``path``: a digest per depth; ``sizes``: bytes of each depth's last text."""
        length = len(path) // WIDTH
        node, child, depth = self.locate(path)
        if child is not None:
            node = self._split(node, child, depth)
        if depth < length:
            leaf = Node(depth, length, path, sizes)
            node.children[leaf.at(depth + 1)] = leaf
            self.handles[leaf.handle()] = leaf
            self.turns += length
            node = leaf
        node.ends.append(conv_id)
        self.turns += 1

    def _split(self, node: Node, child: Node, depth: int) -> Node:
        """A node in the middle of the child's edge."""
        del self.handles[child.handle()]
        middle = Node(child.above, depth, child.path, child.sizes)
        node.children[middle.at(middle.above + 1)] = middle
        child.above = depth
        middle.children[child.at(depth + 1)] = child
        for one in (middle, child):
            self.handles[one.handle()] = one
        return middle

    def expanded(self) -> Iterator[tuple[bytes, int, bytes | None, int, int, int, list[int]]]:
        """(digest, depth, parent's digest, bytes, members, smallest member, members that end here) of every depth."""
        order, open_ = [], [self.root]
        while open_:
            node = open_.pop()
            order.append(node)
            open_.extend(node.children.values())
        counts: dict[int, tuple[int, int]] = {}
        for node in reversed(order):  # children before their parents
            members, least = len(node.ends), node.ends[0] if node.ends else None
            for child in node.children.values():
                more, other = counts.pop(id(child))
                members, least = members + more, other if least is None else min(least, other)
            if not members:
                continue  # an empty trie
            counts[id(node)] = members, least
            if not node.depth:
                yield ROOT, 0, None, 0, members, least, node.ends
            for depth in range(node.above + 1, node.depth + 1):
                yield (node.at(depth), depth, node.at(depth - 1), node.sizes[depth - 1], members, least,
                       node.ends if depth == node.depth else [])


# ---- conversations ----------------------------------------------------------


def shared_turns(conv_id: int) -> int:
    """How many turns a conversation takes from the first of its block."""
    return zlib.crc32(str(conv_id).encode()) % MOST_SHARED


def _prefixes(turns: list[tuple[bytes, int]]) -> tuple[bytes, list[int]]:
    last, path = ROOT, []
    for digest, _ in turns:
        last = hashlib.blake2b(last + digest, digest_size=WIDTH).digest()
        path.append(last)
    return b"".join(path), [size for _, size in turns]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, int]]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


SCHEMA = "digest binary, depth long, parent binary, bytes long, n_convs long, conv_id long, first_end long, ends binary"
_ARROW = pa.schema([
    ("digest", pa.binary()), ("depth", pa.int64()), ("parent", pa.binary()), ("bytes", pa.int64()), ("n_convs", pa.int64()),
    ("conv_id", pa.int64()), ("first_end", pa.int64()), ("ends", pa.binary())])


def _expanded_rows(trie: ZFastTrie, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    rows = ((*node, ends[0] if ends else None, ",".join(map(str, ends)).encode() if ends else None) for *node, ends in trie.expanded())
    while some := list(islice(rows, size)):
        columns = zip(zip(*some, strict=True), _ARROW.types, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in columns], schema=_ARROW)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, digest, bytes) by id and turn -> expanded edges of the tries of the batches."""
    trie, block, base = ZFastTrie(), None, []
    for conv_id, rows in groupby(_rows(batches), key=itemgetter(0)):
        turns = [row[1:] for row in rows]
        first = conv_id - conv_id % BLOCK
        if first != block:
            block, base = first, turns if conv_id == first else []
        shared = shared_turns(conv_id)
        trie.insert(conv_id, *_prefixes(base[:shared] + turns[shared:]))
        if trie.turns >= TRIE_TURNS:
            yield from _expanded_rows(trie)
            trie = ZFastTrie()
    yield from _expanded_rows(trie)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (digest, ends) by digest and first end -> (digest, ends_sha256), whatever many the ends of a node are."""
    at, state, done = None, None, []
    for batch in batches:
        for digest, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if digest == at:
                state.update(b",")
            else:
                if at is not None:
                    done.append((at, state.hexdigest()))
                at, state = digest, hashlib.sha256()
            state.update(ends)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["digest", "ends_sha256"])
            done = []
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()])], names=["digest", "ends_sha256"])


def turn_digest(role: str = "role", text: str = "text"):
    """16 bytes that name a turn; null is as empty."""
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    whole = F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_)
    return F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * WIDTH))


def _totals(paths: DataFrame, tables: Scratch) -> DataFrame:
    """(conv_id, n_leaves, saved): each path with all that hangs on it, from (conv_id, above, n_leaves, saved).

    After round k a path has all within 2 ** k of it, and ``above`` is its ancestor that far up.
    """
    done = tables.write(paths, "trie-totals")
    while done.where("above is not null").limit(1).count():
        below = done.where("above is not null").groupBy("above").agg(F.sum("n_leaves").alias("__leaves"), F.sum("saved").alias("__saved"))
        below = below.withColumnRenamed("above", "__to")
        up = done.select(F.col("conv_id").alias("__of"), F.col("above").alias("__above"))
        added = done.join(below, F.col("conv_id") == F.col("__to"), "left").join(up, F.col("above") == F.col("__of"), "left")
        done = tables.replace(added.select(
            "conv_id", F.col("__above").alias("above"), (F.col("n_leaves") + F.coalesce("__leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("__saved", F.lit(0))).alias("saved")), "trie-totals")
    return done.drop("above")


def conversation_trie(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: the columns of ``op11``'s contract.

    ``conv_id``, the smallest member, and ``depth`` name a node.  Turns go by ``turn``,
    null first, equal ones by their digest; repeated rows are turns each.  A null role
    or text is as an empty one.  Rows without a conv_id take no part, ids are whole
    numbers (of a negative one the block's first is the next multiple of five below).
    Texts of any length are read by Spark alone and only digests travel, 16 bytes a
    turn; a conversation is the unit that no task divides.  Other columns are not read.
    An empty table has no node, not even a root.
    """
    spark = turns.sparkSession
    with scratch_tables(spark) as tables, scratch_tables(spark) as rounds:
        named = tables.write(turns.where(F.col(conv_id).isNotNull()).select(
            F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), turn_digest(role, text).alias("digest"),
            F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("bytes")), "trie-turns")
        block = F.col("conv_id") - F.pmod("conv_id", F.lit(BLOCK))
        ordered = named.repartitionByRange(block).sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "digest")
        edges = tables.write(ordered.select("conv_id", "digest", "bytes").mapInArrow(releasing(_build), SCHEMA), "trie-edges")
        nodes = tables.write(edges.groupBy("digest").agg(
            F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("bytes").alias("bytes"),
            F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id")), "trie-nodes")
        saved = (F.col("n_convs") - 1) * F.col("bytes")
        paths = nodes.groupBy("conv_id").agg(
            F.min(F.struct("depth", "parent")).alias("top"), F.max("depth").alias("bottom"), F.sum(saved).alias("saved"))
        paths = tables.write(paths.select(
            "conv_id", F.col("top.depth").alias("top"), F.col("top.parent").alias("parent"), "bottom", "saved"), "trie-paths")
        owner = nodes.select(F.col("digest").alias("__digest"), F.col("conv_id").alias("above"))
        hung = tables.write(paths.join(owner, F.col("parent") == F.col("__digest")).select(
            "conv_id", "above", (F.col("top") - 1).alias("depth")), "trie-hung")
        branches = hung.groupBy("above", "depth").agg(F.count("*").alias("n"))
        childless = paths.join(
            branches.select(F.col("above").alias("__above"), F.col("depth").alias("__depth")),
            (F.col("conv_id") == F.col("__above")) & (F.col("bottom") == F.col("__depth")), "left")
        starts = childless.select("conv_id", "saved", F.when(F.col("__above").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"))
        starts = starts.join(hung.select("conv_id", "above"), "conv_id", "left")
        totals = _totals(starts.select("conv_id", "above", "n_leaves", "saved"), rounds)
        # a path's nodes, what hangs on each of them, and where the path itself hangs
        arms = hung.join(totals, "conv_id").groupBy(F.col("above").alias("conv_id"), "depth").agg(
            F.count("*").alias("arms"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("more"))
        none = F.lit(None)
        rows = nodes.select(
            "conv_id", "depth", "digest", "n_convs", saved.alias("saved"), F.lit(0).cast("long").alias("arms"),
            F.lit(0).cast("long").alias("leaves"), none.cast("long").alias("hangs_on"))
        rows = rows.union(arms.select(
            "conv_id", "depth", none.cast("binary"), none.cast("long"), F.col("more"), "arms", "leaves", none.cast("long")))
        rows = rows.union(hung.select(
            "conv_id", F.col("depth") + 1, none.cast("binary"), none.cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"),
            F.lit(0).cast("long"), "above"))
        met = rows.repartition("conv_id").groupBy("conv_id", "depth").agg(
            F.max("digest").alias("digest"), F.max("n_convs").alias("n_convs"), F.sum("saved").alias("saved"),
            F.sum("arms").alias("arms"), F.sum("leaves").alias("leaves"), F.max("hangs_on").alias("hangs_on"))
        down = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
        next_ = F.lag(F.lit(1)).over(Window.partitionBy("conv_id").orderBy(F.desc("depth")))
        before = F.lead("depth").over(Window.partitionBy("conv_id").orderBy(F.desc("depth")))
        met = met.withColumn("__below", F.coalesce(next_, F.lit(0))).withColumn("__above", before)
        own_leaf = F.when((F.col("arms") == 0) & (F.col("__below") == 0), 1).otherwise(0)
        summed = met.select(
            "digest", "conv_id", "depth", F.coalesce("hangs_on", F.when(F.col("__above").isNotNull(), F.col("conv_id"))).alias("parent_conv_id"),
            "n_convs", (F.col("arms") + F.col("__below")).cast("long").alias("n_children"),
            F.sum(F.col("leaves") + own_leaf).over(down).alias("n_leaves"), F.sum("saved").over(down).alias("saved_tokens"))
        ends = edges.where("ends is not null").select("digest", "first_end", "ends").repartition("digest")
        ends = ends.sortWithinPartitions("digest", "first_end").select("digest", "ends").mapInArrow(
            releasing(_hashed), "digest binary, ends_sha256 string")
        done = summed.join(ends, "digest", "left").drop("digest")
        done = done.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))
        return materialize(done, "trie")

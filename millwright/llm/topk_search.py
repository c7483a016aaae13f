"""Exact search for the vectors of highest inner product, by branch and bound over columns.

Queries are dealt into groups of bounded size.  A task holds one group and streams a
share of the candidates past it, block by block, those of large norm first.  A block is
stored by dimension: the scores of all its candidates grow by a block of dimensions at
a time, and what the dimensions still to come can add is at most the product of the two
remaining norms.  Candidates that no query can use any more are compacted away; once few
(query, candidate) pairs are open, only these go on.  The bound to beat is the last
score of a query's list so far, so it rises as the blocks pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.text import releasing
from millwright.sources.scratch import materialize

#: Queries that a task holds, and that share a matrix product.
GROUP_QUERIES = 65_536
QUERY_ROWS = 512
#: Candidates of a block, and dimensions that are added up before the bound is asked again.
BLOCK_ROWS = 1_024
BLOCK_DIMS = 16
#: Candidates that pass a group in one task, at least: every task keeps lists of its own.
SHARE_ROWS = 4_096
#: Share of open pairs below which they are gathered one by one.
SPARSE = 0.02
#: Whole numbers below this are exact in a double.
EXACT = 2.0**53
ROOM = 1 + 1e-9


# ---- one block --------------------------------------------------------------


def _remaining(vectors: np.ndarray, cuts: list[int]) -> list[np.ndarray]:
    """For each cut, the norm of every vector (a column) over the dimensions from the cut on."""
    squares = np.square(vectors)
    return [np.sqrt(squares[cut:].sum(axis=0)) for cut in cuts]


def open_pairs(
    queries: np.ndarray, candidates: np.ndarray, least: np.ndarray, block_dims: int = BLOCK_DIMS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of the pairs whose score is the query's ``least`` or more.

    ``queries`` is (queries, dimensions) and ``candidates`` (dimensions, candidates).
    Values are whole numbers in doubles, whose sums stay exact.
    """
    dims = len(candidates)
    cuts = list(range(block_dims, dims, block_dims))
    left, right = _remaining(queries.T, cuts), _remaining(candidates, cuts)
    need = least - 0.5  # scores are whole numbers
    kept = np.arange(candidates.shape[1])
    scores = queries[:, :block_dims] @ candidates[:block_dims]
    for step, cut in enumerate(cuts):
        open_ = scores + np.outer(left[step], right[step][kept] * ROOM) >= need[:, None]
        if np.count_nonzero(open_) < SPARSE * open_.size:
            q, c = np.nonzero(open_)
            return _finish(queries, candidates, need, left, right, cuts, step, q, kept[c], scores[q, c])
        alive = open_.any(axis=0)
        if not alive.all():
            kept, scores = kept[alive], scores[:, alive]
        scores += queries[:, cut : cut + block_dims] @ candidates[cut : cut + block_dims, kept]
    q, c = np.nonzero(scores >= need[:, None])
    return q, kept[c], scores[q, c]


def _finish(queries, candidates, need, left, right, cuts, step, q, c, scores):
    """The open pairs alone over the dimensions from ``cuts[step]`` on, fewer after every block."""
    ends = [*cuts, len(candidates)]
    for at in range(step, len(cuts)):
        for d in range(ends[at], ends[at + 1]):
            scores = scores + queries[q, d] * candidates[d, c]
        more = left[at + 1][q] * right[at + 1][c] * ROOM if at + 1 < len(cuts) else 0
        open_ = scores + more >= need[q]
        q, c, scores = q[open_], c[open_], scores[open_]
    return q, c, scores


class Best:
    """The ``size`` highest scores of each of some queries so far, ties to smaller ids."""

    def __init__(self, queries: int, size: int):
        self.size = size
        self.query, self.score, self.id = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        self.least = np.full(queries, -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query, score, ids = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.id, ids)))
        if score.dtype == object:
            order = np.array(sorted(range(len(query)), key=lambda i: (query[i], -score[i], ids[i])), np.int64)
        else:
            order = np.lexsort((ids, -score, query))
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        stays = place < self.size
        self.query, self.score, self.id = query[stays], score[order][stays], ids[order][stays]
        last = place[stays] == self.size - 1
        self.least[self.query[last]] = self.score[last].astype(float)


def _held(score: int) -> int:
    """A score at the ends of a long where it lies beyond."""
    return max(1 - 2**63, min(2**63 - 1, score))


def _whole(values: np.ndarray) -> np.ndarray:
    """Python's whole numbers, which have no largest."""
    return np.array([int(x) for x in values.ravel()], object).reshape(values.shape)


def search_block(best: Best, queries: np.ndarray, candidates: np.ndarray, ids: np.ndarray) -> None:
    """Let a block of candidates, (dimensions, candidates), pass some queries, (queries, dimensions)."""
    dims = min(queries.shape[1], len(candidates))  # a dimension that one side lacks counts as 0
    queries, candidates = queries[:, :dims], candidates[:dims]
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * dims
    if not most < EXACT:
        scores = _whole(queries) @ _whole(candidates) if dims else np.zeros((len(queries), len(ids)))
        q, c = np.indices(scores.shape).reshape(2, -1)
        found = q, c, np.array([_held(int(x)) for x in scores.ravel()], object)
    elif np.isneginf(best.least).all():  # nothing to beat yet
        scores = queries @ candidates
        top = min(best.size, len(ids))
        q, c = np.nonzero(scores >= -np.partition(-scores, top - 1, axis=1)[:, top - 1 : top])
        found = q, c, scores[q, c]
    else:
        mass = np.square(queries).sum(axis=0) * np.square(candidates).sum(axis=1)
        order = np.argsort(-mass, kind="stable")  # what decides most comes first
        found = open_pairs(queries[:, order], candidates[order], best.least)
    if len(found[0]):
        best.add(found[0], found[2], ids[found[1]])


# ---- tables -----------------------------------------------------------------


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, vector): floor(64 * x) of every component, as a double.

    Rows without an id, null vectors and vectors that hold a null, a NaN or an infinity
    are left out; what 64 times exceeds the doubles stays at the largest.
    """

    def scaled(x: Column) -> Column:
        value = F.least(F.greatest(x * 64, F.lit(-1.7e308)), F.lit(1.7e308))
        return F.when(F.abs(value) < EXACT, F.floor(value).cast("double")).otherwise(value)  # large ones are whole

    values = F.col(embedding).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & ~bad).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.transform(values, scaled).alias("vector"))


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """(rows, dimensions), short vectors filled with 0."""
    sizes = np.diff(vectors.offsets.to_numpy())
    width = int(sizes.max(initial=0))
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def _stacked(parts: list[np.ndarray]) -> np.ndarray:
    width = max((p.shape[1] for p in parts), default=0)
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])


class _Cell:
    """A group of queries and what has passed it."""

    def __init__(self, size: int):
        self.size, self.parts, self.rows, self.ids = size, [], [], []
        self.lists: list[Best] | None = None

    def queries(self, rows: np.ndarray, ids: np.ndarray, matrix: np.ndarray) -> None:
        self.rows.append(rows)
        self.ids.append(ids)
        self.parts.append(matrix)

    def candidates(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        if not self.parts:
            return
        if self.lists is None:
            self.parts = [_stacked(self.parts)]
            count = len(self.parts[0])
            self.lists = [Best(min(QUERY_ROWS, count - at), self.size) for at in range(0, count, QUERY_ROWS)]
        for first in range(0, len(ids), BLOCK_ROWS):
            columns = np.ascontiguousarray(matrix[first : first + BLOCK_ROWS].T)
            for i, best in enumerate(self.lists):
                search_block(best, self.parts[0][i * QUERY_ROWS : (i + 1) * QUERY_ROWS], columns, ids[first : first + BLOCK_ROWS])

    def result(self) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(self.rows) if self.rows else None
        names = np.concatenate(self.ids) if self.ids else None
        for i, best in enumerate(self.lists or []):
            at = best.query + i * QUERY_ROWS
            queries = self.parts[0][i * QUERY_ROWS : (i + 1) * QUERY_ROWS]
            own = [_held(sum(int(x) ** 2 for x in vector)) for vector in queries]
            score = [int(x) for x in best.score]
            same = (best.id == names[at]) & np.array([s == own[q] for s, q in zip(score, best.query, strict=True)], bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[at]), pa.array(names[at]), pa.array(best.id), pa.array(score, pa.int64()), pa.array(same)],
                names=["query_row", "query_id", "vec_id", "score", "own"])


def _searched(size: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cell = None, _Cell(size)
        for batch in batches:
            where = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()  # queries before candidates
            cuts = [0, *(np.flatnonzero(np.diff(where)) + 1), len(where)]
            for first, end in zip(cuts, cuts[1:], strict=False):
                if first == end:
                    continue
                part = batch.slice(first, end - first)
                this, kind = divmod(int(where[first]), 2)
                if this != at:
                    yield from cell.result()
                    at, cell = this, _Cell(size)
                row, ids, matrix = part.column(2).to_numpy(), part.column(3).to_numpy(), _matrix(part.column(4))
                if kind:
                    cell.candidates(ids, matrix)
                else:
                    cell.queries(row, ids, matrix)
        yield from cell.result()

    return search


def top_scores(vectors: DataFrame, asks: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest inner product for every row that ``asks`` picks.

    Every row but the query's own is a candidate; components are floor(64 * x), scores
    whole numbers, held at the ends of a long.  Ties go to smaller ids; fewer than ``k``
    candidates are all returned.  Rows without an id and vectors that are null or hold a
    null, a NaN or an infinity take no part.  A dimension that one of two vectors lacks
    counts as 0, so an empty vector scores 0.  Of repeated rows each is a candidate, and a
    query with ranks of its own; the copies of a query are candidates for it.  A vector is
    held whole, of any length; other columns are not read.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, vec_id, embedding)
    queries = materialize(
        whole_vectors(vectors.where(asks), vec_id, embedding).withColumn("query_row", F.monotonically_increasing_id()), "topk-queries")
    groups = max(1, -(-queries.count() // GROUP_QUERIES))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    shares = max(1, min(-(-tasks // groups), -(-vectors.count() // SHARE_ROWS)))
    norm = F.aggregate("vector", F.lit(0.0), lambda sum_, x: sum_ + x * x)
    group = F.pmod(F.xxhash64("query_row"), F.lit(groups))
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), group.alias("group"), F.lit(0).alias("kind"),
        "query_row", "vec_id", "vector", F.lit(0.0).alias("norm"))
    dealt = whole.withColumn("share", (F.monotonically_increasing_id() % shares).cast("int"))
    passing = dealt.select(
        "share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"), F.lit(1).alias("kind"),
        F.lit(0).cast("long").alias("query_row"), "vec_id", "vector", norm.alias("norm"))
    cells = asked.union(passing).withColumn("cell", F.col("group") * shares + F.col("share"))
    cells = cells.repartition(min(groups * shares, 16 * tasks), "cell").sortWithinPartitions("cell", "kind", F.desc("norm"))
    found = cells.select("cell", "kind", "query_row", "vec_id", "vector").mapInArrow(
        releasing(_searched(k + 1)), "query_row long, query_id long, vec_id long, score long, own boolean")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", F.desc("own"))
    placed = found.withColumn("__at", F.row_number().over(order)).where(F.col("__at") <= k + 1)
    # the query's own row is the first of its id and score
    own = F.min(F.when(F.col("own"), F.col("__at"))).over(Window.partitionBy("query_row"))
    ranked = placed.withColumn("__own", own).where(F.col("__own").isNull() | (F.col("__at") != F.col("__own")))
    rank = F.col("__at") - F.when(F.col("__own") < F.col("__at"), 1).otherwise(0)
    return ranked.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)

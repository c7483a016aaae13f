"""Lines of text files put together to rows whose quoted cells have line breaks.

A line begins a row if the quotes before it in its file are even.  The quotes are
counted within the splits of the files; the sums, a few numbers a split, say whether a
split begins inside a quoted cell.  With them each task puts the lines of its splits
together in the order in which it reads them, so no line is shuffled but those of the
rows that cross from one split into the next.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.sources.scratch import as_named, located

# task functions travel by value: executors need no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LEAST_SPLITS = "spark.sql.files.minPartitionNum"
_SPLIT = ("file", "start", "length")


@dataclass(frozen=True)
class Split:
    """What is known of a split before its lines are read again."""

    file: str
    start: int
    length: int
    odd: int  # lines with an odd number of quotes
    last_odd: int  # whether the last line is one
    inside: bool = False  # whether it begins inside a quoted cell
    row: int = -1  # the split in which the row that it begins in has begun, by number


def quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.text(paths).select(
        "value", as_named(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"), (quotes(F.col("value")) % 2).alias("odd"))


def splits(spark: SparkSession, paths: list[str]) -> list[Split]:
    """The splits of the files in order; a row for each comes to the driver."""
    counted = _lines(spark, paths).withColumn("at", F.monotonically_increasing_id()).groupBy(*_SPLIT).agg(
        F.sum("odd").cast("long").alias("odd"), F.max_by("odd", "at").cast("long").alias("last_odd"))
    found: list[Split] = []
    file, inside, row = None, False, -1
    for r in sorted(counted.collect(), key=lambda r: (r.file, r.start)):
        if r.file != file:
            file, inside, row = r.file, False, -1
        found.append(Split(r.file, r.start, r.length, r.odd, r.last_odd, inside, row))
        if not inside or r.odd > r.last_odd:  # a row begins here
            row = len(found) - 1
        inside ^= bool(r.odd % 2)
    return found


@contextmanager
def steady_splits(spark: SparkSession) -> Iterator[None]:
    """In the block files are split in the same way, whatever executors come or go."""
    before = spark.conf.get(_LEAST_SPLITS, None)
    if before is None:
        spark.conf.set(_LEAST_SPLITS, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_LEAST_SPLITS)


def same_file(spark: SparkSession, path: str) -> str:
    """A path as ``Split`` names it."""
    system, target = located(spark, path)
    return system.makeQualified(target).toString()


def _put_together(known: dict[int, tuple[bool, int, bool]], most: int) -> Callable:
    """Of (split, odd, value) in file order the rows; ``known`` has of a split inside, row and whether it has the header.

    Gives (split, row, n, lines): whole rows with a null ``row``, and of a row that goes
    on in another split its n lines here under the split in which it began.  Lines of a
    row of more than ``most`` are rows of their own; of its pieces only the number is given.
    """
    schema = pa.schema({"split": pa.int32(), "row": pa.int32(), "n": pa.int64(), "lines": pa.list_(pa.string())})

    def rows(split: int, lists: pa.ListArray, row: int | None = None, n: int | None = None) -> pa.RecordBatch:
        count = len(lists)
        return pa.RecordBatch.from_arrays([
            pa.array([split] * count, pa.int32()), pa.array([row] * count, pa.int32()),
            lists.value_lengths().cast(pa.int64()) if n is None else pa.array([n] * count, pa.int64()), lists], schema=schema)

    def listed(values: pa.Array, starts: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)

    class Open:
        """The last row that has begun, as far as it has been read."""

        def __init__(self, split: int, row: int | None):
            self.split, self.row, self.held, self.n = split, row, [], 0

        def add(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
            self.n += len(values)
            self.held.append(values)
            if self.n > most:
                alone = pa.concat_arrays(self.held)
                self.held = []
                if len(alone):
                    yield rows(self.split, listed(alone, np.arange(len(alone))))

        def close(self, goes_on: bool) -> Iterator[pa.RecordBatch]:
            row = self.split if self.row is None and goes_on else self.row
            if not self.n or (row is None and self.n > most):
                return
            lines = pa.concat_arrays(self.held) if self.held else pa.array([], pa.string())
            yield rows(self.split, listed(lines, np.zeros(1, int)), row, self.n)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parity = None, 0
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.diff(numbers)) + 1
            for begin, end in zip([0, *edges], [*edges, len(numbers)], strict=True):
                if begin == end:
                    continue
                split = int(numbers[begin])
                odd, values = batch.column(1).to_numpy()[begin:end], batch.column(2).slice(begin, end - begin)
                if last is None or last.split != split:
                    if last is not None:
                        yield from last.close(bool(parity))
                    inside, row, has_header = known[split]
                    last, parity = Open(split, row if inside else None), int(inside)
                    if has_header:  # which counts quotes and is no row
                        parity, odd, values = int(odd[0]), odd[1:], values[1:]
                before = (parity + np.cumsum(odd) - odd) % 2
                parity = (parity + int(odd.sum())) % 2
                starts = np.flatnonzero(before == 0)
                if not len(starts):
                    yield from last.add(values)
                    continue
                yield from last.add(values.slice(0, starts[0]))
                yield from last.close(False)
                whole = values.slice(starts[0], starts[-1] - starts[0])
                if len(whole):
                    at = starts[:-1] - starts[0]
                    for i in np.flatnonzero(np.diff(starts) > most):
                        at = np.union1d(at, np.arange(starts[i], starts[i + 1]) - starts[0])
                    yield rows(split, listed(whole, at))
                last = Open(split, None)
                yield from last.add(values.slice(starts[-1]))
        if last is not None:
            yield from last.close(bool(parity))

    return work


def rows_of_lines(spark: SparkSession, paths: list[str], found: list[Split], most: int) -> DataFrame:
    """(file, lines) of every row of the files, which are those of ``found``, without their header lines.

    Lines of a row of more than ``most`` lines are rows of their own.
    """
    known = {i: (s.inside, s.row, s.start == 0) for i, s in enumerate(found)}
    ends_inside = [s.inside ^ bool(s.odd % 2) for s in found]
    numbered = spark.createDataFrame(
        [(s.file, s.start, s.length, i, s.inside or ends_inside[i]) for i, s in enumerate(found)],
        "file string, start long, length long, split int, crossed boolean")
    lines = _lines(spark, paths).join(F.broadcast(numbered), list(_SPLIT), "left")
    unknown = F.raise_error(F.lit("a file was split in another way than when its quotes were counted"))
    read = lines.select(F.coalesce("split", unknown.cast("int")).alias("split"), F.col("odd").cast("int"), "value", "crossed")

    def put(lines: DataFrame) -> DataFrame:
        return lines.drop("crossed").mapInArrow(_put_together(known, most), "split int, row int, n long, lines array<string>")

    pieces = put(read.where("crossed")).where("row is not null").groupBy("row").agg(
        F.sum("n").alias("n"), F.flatten(F.sort_array(F.collect_list(F.struct("split", "lines")))["lines"]).alias("lines"))
    one_by_one = F.transform("lines", lambda line: F.array(line))
    joined = pieces.select(
        F.col("row").alias("split"), F.explode(F.when(F.col("n") <= most, F.array("lines")).otherwise(one_by_one)).alias("lines"))
    whole = put(read).where("row is null").select("split", "lines").union(joined)
    return whole.join(F.broadcast(numbered.select("split", "file")), "split").select("file", "lines")

"""Connected components by alternating star steps, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.sources.scratch import Scratch, in_few_files


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets the node's smallest neighbour (or the node)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    return both.join(least, F.col("u") == F.col("n")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours get the smallest of them; ``u`` is the larger end."""
    least = _least(edges).withColumnRenamed("u", "n")
    joined = edges.join(least, F.col("u") == F.col("n"))
    moved = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("n").alias("u"), F.col("m").alias("v")))


def _sign(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    row = edges.agg(F.count("*").alias("n"), F.sum(hashed).alias("h")).first()
    return row.n, row.h


def components(
    links: DataFrame, tables: Scratch, left: str = "a", right: str = "b", most: int | None = None
) -> DataFrame:
    """(node, root) of every node of ``links`` that is not the smallest of its component.

    Links between a node and itself, repeated links and either direction are fine;
    rows with a null end are left out.  Each round is one of ``tables``, which the
    result reads, and makes some shuffles of as many rows as there are links at most;
    a node that most links share is summed on the map side, and its side of the join
    is split.  ``most`` says how many links there may be, where that is known.
    """
    a, b = F.col(left), F.col(right)
    edges = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = tables.write(edges if most is None else in_few_files(edges, most), "links")
    sign, before = _sign(edges), None
    while sign[0] and sign != before:
        stars = _small_star(_large_star(edges).distinct()).distinct()
        edges = tables.write(in_few_files(stars, 2 * sign[0]), "stars")
        sign, before = _sign(edges), sign
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))

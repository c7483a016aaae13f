import hashlib
import math
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millwright.functions.digests import row_digest
from millwright.operators.splitting import split_leakage, stratified_split, train_quotas


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def brute_force(rows, seed=42, test_size=0.2):
    """(id, y) rows ordered by digest per class, first quota to train."""
    by_class = defaultdict(list)
    for id_, y in rows:
        by_class[y].append((hashlib.md5(f"{seed}:{id_}".encode()).hexdigest(), id_))
    quotas = train_quotas({y: len(v) for y, v in by_class.items()}, test_size)
    out = Counter()
    for y, members in by_class.items():
        for place, (_, id_) in enumerate(sorted(members)):
            out[(id_, y, "train" if place < quotas[y] else "test")] += 1
    return out


@given(st.dictionaries(st.integers(0, 20), st.integers(2, 500), min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_quotas_are_exact_and_proportional(counts):
    total = sum(counts.values())
    n_train = total - math.ceil(0.2 * total)
    if min(n_train, total - n_train) < len(counts):
        with pytest.raises(ValueError):
            train_quotas(counts)
        return
    quotas = train_quotas(counts)
    assert sum(quotas.values()) == n_train
    for c, n in counts.items():
        assert n * n_train // total <= quotas[c] <= n * n_train // total + 1


def test_published_size():
    quotas = train_quotas({0: 7218, 1: 12317})
    assert sum(quotas.values()) == 15628


@pytest.mark.parametrize("rank_rows", [10, 1_000_000])
def test_matches_brute_force(spark, rank_rows):
    rows = [(i, i % 3) for i in range(997)]
    df = spark.createDataFrame(rows, "id long, y int")
    got = stratified_split(df, "y", ["id"], rank_rows=rank_rows)
    assert rows_of(got) == brute_force(rows)
    assert rows_of(stratified_split(df.repartition(7, "id"), "y", ["id"])) == brute_force(rows)


@pytest.mark.parametrize("rank_rows", [1, 1_000_000])
def test_copies_are_divided_exactly(spark, rank_rows):
    """Each class is mostly copies of one row, so both cuts fall among copies."""
    hot = spark.range(900).select(F.lit(1.5).alias("x"), F.lit(None).cast("string").alias("t"),
                                  (F.col("id") % 2).cast("int").alias("y"))
    few = spark.range(100).select((F.col("id") + 2.0).alias("x"), F.lit("a").alias("t"),
                                  (F.col("id") % 2).cast("int").alias("y"))
    df = hot.unionByName(few)
    out = stratified_split(df, "y", rank_rows=rank_rows)
    assert rows_of(out.drop("split")) == rows_of(df)
    assert rows_of(out.groupBy("y", "split").count()) == Counter(
        {(0, "train", 400): 1, (0, "test", 100): 1, (1, "train", 400): 1, (1, "test", 100): 1}
    )
    leak = split_leakage(out).first()
    assert leak.shared_rows == 2 and leak.affected_rows == 900


@pytest.mark.parametrize("rank_rows", [1, 1_000_000])
def test_one_key_shared_by_most_rows(spark, rank_rows):
    df = spark.range(500).select(
        F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 5).alias("v"), F.lit(1).alias("y"),
    )
    out = stratified_split(df, "y", ["k"], rank_rows=rank_rows)
    assert rows_of(out.drop("split")) == rows_of(df)
    assert out.where("split = 'train'").count() == 400
    shared = stratified_split(df.repartition(5), "y", ["k"])
    assert rows_of(shared) == rows_of(out)


def test_refuses_what_cannot_be_stratified(spark):
    with pytest.raises(ValueError, match="fewer than 2"):
        stratified_split(spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id int, y int"), "y")
    with pytest.raises(ValueError, match="no y"):
        stratified_split(spark.createDataFrame([(1, 0), (2, None)], "id int, y int"), "y")
    with pytest.raises(ValueError, match="nothing"):
        stratified_split(spark.createDataFrame([], "id int, y int"), "y")


def test_assignment_does_not_shuffle_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = stratified_split(df, "event_type", ["event_id"])._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert "BroadcastHashJoin" in physical
    assert "hashpartitioning" not in physical and "rangepartitioning" not in physical


def test_digest_tells_gaps_apart(spark):
    df = spark.createDataFrame(
        [(None, 1.0), (1.0, None), (None, None), (0.0, 1.0), (float("nan"), 1.0)], "a double, b double"
    )
    digests = [r[0] for r in df.select(row_digest(["a", "b"], 42)).collect()]
    assert len(set(digests)) == 5 and {len(d) for d in digests} == {32}


def test_copies_of_many_classes_are_spread_over_tasks(spark):
    """The first chunks of train copies of all classes do not meet in one task."""
    rows = spark.range(40 * 50).selectExpr("id % 40 as y", "'same' as text")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        done = stratified_split(rows, "y").where("split = 'train'")
        per_task = [r.n for r in done.groupBy(F.spark_partition_id().alias("p"), "y").count().groupBy("p").agg(
            F.sum("count").alias("n")).collect()]
        placed = done.select("y", F.spark_partition_id().alias("p")).distinct().groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(per_task) == 1600 and len(placed) > 1
    assert max(r["count"] for r in placed) < 40

import math
from collections import Counter

from pyspark.sql import functions as F

from millwright.operators import bloom, merging
from millwright.sources.scratch import ROWS_PER_TASK, SPLIT_BYTES, bounded_tasks

NAN = float("nan")
SCHEMA = "a double, b string"


def bag(df):
    return Counter(
        tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in df.collect()
    )


def tables(spark):
    base = spark.createDataFrame(
        [(1.0, "x"), (1.0, "x"), (None, "y"), (NAN, None), (-0.0, "z"), (7.0, None)], SCHEMA
    )
    batch = spark.createDataFrame(
        [(1.0, "x"), (None, "y"), (NAN, None), (0.0, "z"), (2.0, "n"), (2.0, "n"), (None, None)], SCHEMA
    )
    return base, batch


def test_merge_treats_gaps_as_values(spark):
    base, batch = tables(spark)
    merged = merging.merge_distinct(base, batch)
    assert sum(bag(merged).values()) == 7
    assert bag(merging.merge_distinct(batch, base)) == bag(merged)
    assert bag(merging.merge_distinct(merged, batch)) == bag(merged)
    assert merging.duplicates_removed(base, batch).first()[0] == 6


def test_report(spark):
    report = merging.merge_report(*tables(spark)).first().asDict()
    assert report == {
        "base_rows": 6, "batch_rows": 7, "concat_rows": 13, "duplicates_removed": 6,
        "new_rows": 2, "merged_rows": 7,
    }


def test_empty_tables(spark):
    base, batch = tables(spark)
    assert merging.merge_report(base.limit(0), batch.limit(0)).first().merged_rows == 0
    assert merging.new_rows(base.limit(0), batch).count() == 6


def test_new_rows_by_either_way(spark):
    base, batch = tables(spark)
    want = bag(spark.createDataFrame([(2.0, "n"), (None, None)], SCHEMA))
    assert bag(merging.new_rows(base, batch)) == want
    distinct = base.dropDuplicates()
    assert bag(merging.new_rows(distinct, batch, base_is_distinct=True)) == want
    assert bag(merging.new_rows(distinct, batch, base_is_distinct=True, broadcast_bytes=0)) == want


def test_columns_by_name_and_absent_ones_empty(spark):
    base, _ = tables(spark)
    wider = spark.createDataFrame([("x", 1.0, 5), ("q", 9.0, 6)], "b string, a double, c int")
    union = merging.union_all(base, wider)
    assert union.columns == ["a", "b", "c"] and union.where("c is null").count() == 6
    fresh = merging.new_rows(base.dropDuplicates(), wider, base_is_distinct=True)
    assert bag(fresh) == Counter({(1.0, "x", 5): 1, (9.0, "q", 6): 1})


def test_small_batch_leaves_the_base_unshuffled(spark):
    base = spark.range(1000).select(F.col("id").cast("double").alias("a"))
    batch = spark.range(990, 1010).select(F.col("id").cast("double").alias("a"))
    fresh = merging.new_rows(base, batch, base_is_distinct=True)
    assert fresh.count() == 10
    known = merging._matching(base, batch, "left_semi")
    for step, kind in ((known, "LeftSemi"), (fresh, "LeftAnti")):
        plan = step._jdf.queryExecution().executedPlan().toString()
        assert f"{kind}, BuildRight" in plan and "hashpartitioning" not in plan


def test_a_large_batch_meets_only_what_its_filter_lets_through(spark):
    base = spark.range(300_000).selectExpr("cast(id as double) a", "if(id % 5 = 0, null, concat('r', id)) b")
    batch = spark.range(299_000, 301_000).selectExpr("cast(id as double) a", "if(id % 5 = 0, null, concat('r', id)) b").repartition(3)
    passed = merging.through_filter(base, batch, merging.FILTER_BYTES)
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan  # the base is scanned where it lies
    found = bag(passed)
    assert 1_000 <= sum(found.values()) <= 2 * batch.count()
    assert bag(batch.where("a < 300000")).keys() <= found.keys()
    fresh = merging.new_rows(base, batch, base_is_distinct=True, broadcast_bytes=merging.size_in_bytes(batch) // 2)
    assert bag(fresh) == bag(batch.where("a >= 300000"))
    assert merging.through_filter(base, batch, 1) is None
    assert merging.new_rows(base, batch.limit(0), True, -1).count() == 0
    assert merging.new_rows(base.limit(0), batch, True, 0).count() == 2_000


def test_filters_hold_every_row_and_few_others(spark):
    rows = spark.range(40_000).selectExpr("id", "cast(id % 13 as float) f", "cast(if(id % 3 = 0, null, id) as string) s")
    for hashes in (1, bloom.HASHES, bloom.MOST_HASHES):
        n = bloom.buckets_for(40_000, 2 * hashes)
        bits = bloom.build(rows, bloom.row_hash(rows.schema), n, hashes)
        asked = rows.unionByName(rows.selectExpr("id + 100000 id", "f", "s")).withColumn("h", bloom.row_hash(rows.schema))
        met = asked.withColumn("bucket", bloom.bucket(F.col("h"), n)).join(bits, "bucket").where(bloom.may_hold(F.col("h"), hashes))
        assert met.where("id < 100000").count() == 40_000
        assert met.where("id >= 100000").count() <= (40_000 if hashes == 1 else 100)
        assert bits.agg(F.sum("rows")).first()[0] == 40_000


def test_filters_are_built_without_sorting_rows(spark, monkeypatch):
    """The bits are those that Spark's own bitmap has, also when a task lets buckets go."""
    monkeypatch.setattr(bloom, "HELD_BUCKETS", 3)
    rows = spark.range(0, 20_000, 1, 3).select("id", (F.col("id") % 2).cast("string").alias("file"))
    hash_, n = F.xxhash64("id"), 8
    found = bloom.build(rows, hash_, n, by=("file",))
    placed = rows.select("file", bloom.bucket(hash_, n).alias("bucket"), F.explode(F.array(*bloom._positions(hash_, 8))).alias("bit"))
    want = placed.groupBy("file", "bucket").agg(
        (F.count("bit") / 8).cast("long").alias("rows"), F.bitmap_construct_agg("bit").alias("bits"))
    word = F.array_join(F.transform("words", lambda w: F.lpad(F.hex(w), 8, "0")), "")
    got = found.select("file", "bucket", "rows", F.unhex(word).alias("bits"))
    assert bag(got) == bag(want) and got.count() == 16
    # the sort that is left is of whole buckets
    assert found._jdf.queryExecution().executedPlan().toString().count("Generate") == 0


def test_bounded_tasks_ends_with_the_block(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(n) for n in names]
    with bounded_tasks(spark, 100 * ROWS_PER_TASK):
        assert spark.conf.get(names[0]) == str(SPLIT_BYTES) and spark.conf.get(names[1]) == "100"
    assert [spark.conf.get(n) for n in names] == before

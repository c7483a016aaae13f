import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright.operators import boosting as bo
from millwright.operators import trees
from millwright.operators.evaluation import Flags
from millwright.plans.training import evaluate_model, train_and_promote
from millwright.schema import FEATURES, TARGET
from millwright.sources.registry import ModelRegistry
from millwright.sources.scratch import children, scratch_root
from millwright.plans.scoring import score
from millwright.streaming.scoring import start_registry_scoring, start_scoring
from tests.conftest import SF_DIR
from workload import fixtures as fx

PARAMS = bo.BoostParams(n_trees=3, max_depth=3, learning_rate=0.3)


@pytest.fixture(scope="module")
def rows(spark):
    return fx.keyed_readings(spark, SF_DIR)


@pytest.fixture(scope="module")
def newton(rows):
    return bo.train_newton(rows, params=PARAMS, key=[fx.KEY])


def brute_newton(x, y, params, edges):
    """Same method on plain arrays, every row and column used."""
    bins = np.stack([np.searchsorted(edges[j], x[:, j], side="right") for j in range(x.shape[1])])
    margin = np.full(len(y), math.log(y.mean() / (1 - y.mean())))

    def score(g, h):
        return max(abs(g) - params.alpha, 0.0) ** 2 / (h + params.lambda_)

    def leaf(g, h):
        return -params.learning_rate * math.copysign(max(abs(g) - params.alpha, 0.0), g) / (h + params.lambda_)

    def grow(at, depth, g, h, out):
        best = None
        if depth < params.max_depth:
            for j in range(len(bins)):
                for b in np.unique(bins[j][at]):
                    left = at & (bins[j] <= b)
                    gl, hl = g[left].sum(), h[left].sum()
                    gr, hr = g[at].sum() - gl, h[at].sum() - hl
                    gain = score(gl, hl) + score(gr, hr) - score(g[at].sum(), h[at].sum())
                    if min(hl, hr) >= params.min_child_weight and gain > params.gamma:
                        if best is None or gain > best[0] + 1e-9:
                            best = (gain, left)
        if best is None:
            out[at] += leaf(g[at].sum(), h[at].sum())
            return
        grow(best[1], depth + 1, g, h, out)
        grow(at & ~best[1], depth + 1, g, h, out)

    for _ in range(params.n_trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - y) * 2**20) / 2**20, np.rint(p * (1 - p) * 2**20) / 2**20
        grow(np.ones(len(y), bool), 0, g, h, margin)
    return 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("extra", [0, 3])
def test_newton_equals_plain_arrays(spark, rows, extra):
    """With three more columns the bins of a row take two words."""
    params = bo.BoostParams(n_trees=2, max_depth=3, learning_rate=0.3, row_sample=1.0,
                            column_sample=1.0, max_bins=16, min_child_weight=5.0)
    features = [*FEATURES, *[f"extra{i}" for i in range(extra)]]
    rows = rows.withColumns({
        f"extra{i}": ((F.col(fx.KEY) * (i + 3)) % 11).cast("double") for i in range(extra)
    })
    model = bo.train_newton(rows, features, params=params, key=[fx.KEY])
    data = rows.toPandas()
    edges = bo._bin_edges(rows.select(*features), features, 16)
    want = brute_newton(data[features].to_numpy(float), data[TARGET].to_numpy(float), params, edges)
    got = dict(model.transform(rows).select(fx.KEY, "probability").collect())
    assert np.allclose([got[k] for k in data[fx.KEY]], want, atol=1e-9)


def test_newton_does_not_depend_on_partitioning(rows, newton, monkeypatch):
    edges = bo._bin_edges(rows.select(*FEATURES), FEATURES, PARAMS.max_bins)
    monkeypatch.setattr(bo, "_bin_edges", lambda *_: edges)
    kept = bo.train_newton(rows, params=PARAMS, key=[fx.KEY])
    again = bo.train_newton(rows.repartition(5, "coolant_temp"), params=PARAMS, key=[fx.KEY])
    assert again == kept


def test_newton_round_trip_and_metrics(spark, rows, newton, folder):
    newton.save(spark, f"{folder}/m")
    assert bo.NewtonModel.load(spark, f"{folder}/m") == newton
    assert newton.tree_table(spark).where("feature is null and leaf_value is null").isEmpty()
    assert evaluate_model(newton, rows).first().roc_auc > 0.6


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_newton_without_a_key_does_not_depend_on_the_layout(rows, partitions):
    edges = bo._bin_edges(rows, FEATURES, 32)
    params = bo.BoostParams(n_trees=2, max_depth=3, learning_rate=0.3)
    kept = bo.train_newton(rows, params=params, edges=edges)
    assert bo.train_newton(rows.repartition(partitions), params=params, edges=edges) == kept


def test_newton_learns_a_side_for_absent_values(spark, rows):
    """Absent values of the deciding feature go where their class is."""
    gapped = rows.withColumn("engine_rpm", F.when(F.col(TARGET) == 0, F.col(fx.KEY) % 1000 + 100.0)
                             .when(F.col(fx.KEY) % 2 == 0, F.col(fx.KEY) % 1000 + 5_000.0))
    params = bo.BoostParams(n_trees=1, max_depth=1, column_sample=0.2, row_sample=1.0, min_child_weight=1.0)
    edges = [[500.0, 3_000.0]]
    models = [bo.train_newton(gapped, ["engine_rpm"], params=params, edges=edges)]
    flipped = gapped.withColumn(TARGET, 1 - F.col(TARGET))
    models.append(bo.train_newton(flipped, ["engine_rpm"], params=params, edges=edges))
    nan = gapped.withColumn("engine_rpm", F.coalesce("engine_rpm", F.lit(float("nan"))))
    for model, data in zip(models, (nan, flipped), strict=True):
        assert not model.trees[0].absent_left[0]
        wrong = model.transform(data).where((F.col("probability") > F.lit(1 / (1 + math.exp(-model.start)))) != (F.col(TARGET) == 1))
        assert wrong.isEmpty()
    lower = gapped.withColumn("engine_rpm", -F.col("engine_rpm"))
    assert bo.train_newton(lower, ["engine_rpm"], params=params, edges=[[-3_000.0]]).trees[0].absent_left[0]
    assert evaluate_model(models[0], gapped, ["engine_rpm"]).first().unusable_test_rows == 0


def test_masks_score_as_a_walk_does(spark):
    """To the bit, for thresholds that trees share, absent and infinite values, and trees of one leaf."""
    pick, numbers = random.Random(1), np.random.default_rng(1)

    def grow(tree, node, depth):
        tree.value[node] = pick.uniform(-1, 1)
        if depth < 6 and pick.random() < 0.9:
            tree.feature[node], tree.absent_left[node] = pick.randrange(3), pick.random() < 0.5
            tree.threshold[node] = pick.choice([pick.randrange(250) / 10, 3.5, math.inf])
            grow(tree, 2 * node + 1, depth + 1)
            grow(tree, 2 * node + 2, depth + 1)

    trees_ = [bo.Tree.empty(6) for _ in range(60)]
    for tree in trees_:
        grow(tree, 0, 0)
    x = numbers.uniform(-2, 27, (5_000, 3)).round(1)
    x[numbers.random(x.shape) < 0.1] = np.nan
    x[:20], x[20:40] = math.inf, -math.inf
    walk = bo.walked(x, trees_, 0.25, 6)
    assert (bo.Forest.of(trees_, 3).margins(x, 0.25) == walk).all()
    assert (bo.Forest.of([], 3).margins(x, 0.25) == 0.25).all()
    rows = spark.createDataFrame(x[:300].tolist(), "a double, b double, c double")
    model = bo.NewtonModel(["a", "b", "c"], 0.25, 6, trees_)
    assert [r.probability for r in model.transform(rows).collect()] == (1 / (1 + np.exp(-walk[:300]))).tolist()
    deeper = bo.NewtonModel(["a", "b", "c"], 0.25, 7, trees_)
    assert deeper.transform(rows).exceptAll(model.transform(rows)).isEmpty()


def test_margins_survive_a_rewrite_of_the_state(rows, monkeypatch):
    edges = bo._bin_edges(rows, FEATURES, 32)
    params = bo.BoostParams(n_trees=5, max_depth=2, learning_rate=0.3)
    kept = bo.train_newton(rows, params=params, edges=edges)
    for trees_ in (1, 2, 3):
        monkeypatch.setattr(bo, "REWRITE_TREES", trees_)
        assert bo.train_newton(rows, params=params, edges=edges) == kept


def test_a_tree_level_is_one_stage(spark, rows):
    edges = bo._bin_edges(rows, FEATURES, 32)

    def stages(n_trees):
        context, group = spark.sparkContext, f"boost-{n_trees}"
        context.setJobGroup(group, "boosting")
        bo.train_newton(rows, params=bo.BoostParams(n_trees=n_trees, max_depth=3, learning_rate=0.3), edges=edges)
        context.setJobGroup("rest", "")
        jobs = [context.statusTracker().getJobInfo(job) for job in context.statusTracker().getJobIdsForGroup(group)]
        return sum(len(job.stageIds) for job in jobs)

    assert 0 < stages(3) - stages(2) <= 3


def test_draws_and_sums_are_those_of_spark(spark, rows, monkeypatch):
    keyed = rows.select(F.xxhash64(fx.KEY).alias("id"))
    found = keyed.select(F.xxhash64("id", F.lit(42)), F.pmod(F.xxhash64("id", F.lit(42), F.lit(7)), F.lit(10_000)) < 8_000).collect()
    assert bo._drawn(np.array([r[0] for r in found]), 7, 0.8).tolist() == [r[1] for r in found]
    edges = bo._bin_edges(rows, FEATURES, 32)
    params = bo.BoostParams(n_trees=2, max_depth=3, learning_rate=0.3)
    kept = bo.train_newton(rows, params=params, edges=edges)
    monkeypatch.setattr(bo, "GATHER_BYTES", 0)
    monkeypatch.setattr(bo, "BLOCK_ROWS", 100)
    assert bo.train_newton(rows, params=params, edges=edges) == kept


def test_newton_leaves_no_scratch_tables(spark, rows):
    before = len(children(spark, scratch_root(spark)))
    with pytest.raises(ValueError):
        bo.train_newton(rows.where(F.col(TARGET) == 0), params=PARAMS)
    bo.train_newton(rows, params=bo.BoostParams(n_trees=2, max_depth=2))
    assert len(children(spark, scratch_root(spark))) == before


def test_unusable_rows_are_counted(spark, rows):
    gapped = rows.withColumn("engine_rpm", F.when(F.col(fx.KEY) % 3 != 0, F.col("engine_rpm")))
    absent = gapped.where("engine_rpm is null").count()
    model = trees.train_gbt(gapped, n_trees=1, maxDepth=2)
    row = evaluate_model(model, gapped).first()
    assert (row.test_rows, row.unusable_test_rows) == (gapped.count() - absent, absent)


def test_spark_ml_meets_the_rows_in_even_tasks(spark, monkeypatch):
    """A partition more than there are cores, or a fuller one, is dealt out; what lies evenly stays."""
    met, cores = [], spark.sparkContext.defaultParallelism

    class Met:
        def fit(self, df):
            at = df.withColumn("at", F.spark_partition_id()).groupBy("at").count().collect()
            met.append((sorted(r["count"] for r in at), df.collect()))

    monkeypatch.setattr(trees, "gbt_pipeline", lambda *a, **k: Met())
    monkeypatch.setattr(trees, "ROWS_PER_TASK", 50, raising=False)
    names = [*FEATURES, TARGET]
    data = [tuple(float((i * (j + 3)) % 17) for j in range(len(FEATURES))) + (i % 2,) for i in range(1_000)]
    schema = ", ".join(f"{c} double" for c in FEATURES) + f", {TARGET} int"
    even = spark.createDataFrame(spark.sparkContext.parallelize(data, cores), schema)
    one_more = spark.createDataFrame(spark.sparkContext.parallelize(data, cores + 1), schema)
    fuller = spark.createDataFrame(spark.sparkContext.parallelize(data, 2 * cores), schema).coalesce(cores - 1)
    for df in (even, one_more, fuller):
        trees.train_gbt(df)
    for sizes, rows_ in met:
        assert len(sizes) == cores and sizes[-1] - sizes[0] <= 2 * cores
        assert sorted(tuple(r) for r in rows_) == sorted(data)
    assert [tuple(r) for r in met[0][1]] == data  # not dealt again
    assert not [path for path in children(spark, scratch_root(spark)) if "gbt-rows" in path]
    few = spark.createDataFrame(spark.sparkContext.parallelize(data[:40], 1), schema)
    trees.train_gbt(few)
    assert [tuple(r) for r in met[-1][1]] == data[:40]


def test_a_scored_table_can_be_scored_again(rows):
    model = trees.train_gbt(rows, n_trees=1, maxDepth=2)
    once = trees.with_probability(model, rows.withColumn("prediction", F.lit(7)))
    again = trees.with_probability(model, once)
    assert again.columns == once.columns and again.exceptAll(once).isEmpty()


def test_training_needs_both_classes(rows):
    with pytest.raises(ValueError, match="both classes"):
        bo.train_newton(rows.where(F.col(TARGET) == 0), params=PARAMS)


def test_preset_matches_the_tuned_parameters():
    gbt = trees.gbt_pipeline().getStages()[-1]
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize()) == (250, 6, 0.01)
    assert (gbt.getSubsamplingRate(), gbt.getFeatureSubsetStrategy(), gbt.getSeed()) == (0.8, "0.6", 42)
    p = bo.BoostParams()
    assert (p.gamma, p.alpha, p.lambda_, p.min_child_weight) == (0.5, 0.5, 7.0, 10.0)


def test_promotion_run(spark, rows, newton, folder):
    train = rows.where(F.col(fx.KEY) % 5 != 0)
    test = rows.where(F.col(fx.KEY) % 5 == 0)
    registry = ModelRegistry(spark, f"{folder}/registry")
    assert registry.current() is None

    def stump(df, features, label):
        return trees.train_gbt(df, features, label, n_trees=1, maxDepth=1, minInstancesPerNode=1)

    first = train_and_promote(train, test, registry, trainer=stump)
    assert not first.publish and first.reason == "not compared" and first.version is None
    forced = train_and_promote(train, test, registry, Flags(force=True), stump)
    assert forced.version == 0 and forced.reason == "forced without comparison"
    same = train_and_promote(train, test, registry, trainer=stump)
    assert not same.publish and same.reason == "no improvement"
    assert same.comparison.where("diff != 0").isEmpty()
    better = train_and_promote(train, test, registry, trainer=lambda *_: newton)
    assert better.version == 1 and better.reason == "improved"
    version, model = registry.current()
    assert version == 1 and model == newton  # as it was trained
    newer = train_and_promote(train, test, registry, trainer=stump, data_version=3)
    assert not newer.data_updated  # no published model names the version it learned from
    train_and_promote(train, test, registry, Flags(force=True), lambda *_: newton, data_version=3)
    assert not train_and_promote(train, test, registry, trainer=stump, data_version=3).data_updated
    updated = train_and_promote(train, test, registry, trainer=lambda *_: newton, data_version=4)
    assert updated.data_updated and updated.publish and updated.reason == "forced without comparison"
    assert registry.data_version() == 4 and registry.log().where("unusable_train_rows = 0").count() >= 2
    idle = train_and_promote(train, test, registry, Flags(train=False))
    assert not idle.publish and idle.model == newton and idle.new_metrics is None


def test_stream_scores_like_the_batch(spark, rows, newton, folder):
    rows.repartition(3).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    start_scoring(stream, newton, f"{folder}/out", f"{folder}/check", fx.SENSORS).awaitTermination()
    batch = score(rows, newton, fx.SENSORS)
    got = spark.read.schema(batch.schema).parquet(f"{folder}/out")
    assert got.exceptAll(batch).isEmpty() and got.count() == rows.count()
    assert got.where("not accepted and prediction is not null").isEmpty()


def test_a_stream_picks_up_a_published_model(spark, rows, newton, folder):
    """Batch by batch while it runs, and again when a batch is retried."""
    registry = ModelRegistry(spark, f"{folder}/registry")
    first, second = (rows.orderBy(fx.KEY).limit(n).coalesce(1) for n in (40, 30))
    first.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")

    def run():
        start_registry_scoring(stream, registry, f"{folder}/out", f"{folder}/check", fx.SENSORS).awaitTermination()

    with pytest.raises(Exception, match="no published model"):
        run()
    registry.publish(newton, {}, "first")
    run()
    registry.publish(bo.NewtonModel(list(FEATURES), 9.0, 3), {}, "second")
    second.write.mode("append").parquet(f"{folder}/in")
    run()
    run()
    got = spark.read.parquet(f"{folder}/out")
    assert {r.model_version: r["count"] for r in got.groupBy("model_version").count().collect()} == {0: 40, 1: 30}
    assert got.where("model_version = 1 and accepted and prediction = 0").isEmpty()
    before = got.where("model_version = 0").drop("batch")
    batch = score(first, newton, fx.SENSORS)
    assert before.select(batch.columns).exceptAll(batch).isEmpty()

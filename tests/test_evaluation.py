import random
from itertools import product

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from millwright.operators import evaluation as ev
from millwright.plans.training import decide


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "engine_condition int, probability double")


def brute_auc(pairs):
    positives = [s for y, s in pairs if y == 1]
    negatives = [s for y, s in pairs if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    return wins / (len(positives) * len(negatives))


def ties(n, seed=3):
    rng = random.Random(seed)
    return [(rng.randint(0, 1), rng.choice([0.5, 0.5, rng.random(), rng.random() / 1e6])) for _ in range(n)]


@pytest.mark.parametrize("window_rows", [7, 1_000_000])
def test_auc_is_exact_with_ties_and_crowded_scores(spark, window_rows):
    pairs = ties(300)
    df = scored(spark, pairs)
    auc = ev.roc_auc(df, window_rows=window_rows).first().roc_auc
    assert auc == pytest.approx(brute_auc(pairs), abs=1e-12)
    reference = BinaryClassificationEvaluator(
        rawPredictionCol="probability", labelCol="engine_condition", numBins=0
    ).evaluate(df)
    assert auc == pytest.approx(reference, abs=1e-12)
    flipped = df.withColumn("probability", -F.col("probability"))
    assert ev.roc_auc(flipped).first().roc_auc == pytest.approx(1 - auc, abs=1e-12)


def test_threshold_is_exclusive_and_undefined_is_zero(spark):
    row = ev.evaluate(scored(spark, [(1, 0.5), (0, 0.1), (0, 0.2)])).first()
    assert (row.accuracy, row.precision, row.recall, row.f1_score) == (2 / 3, 0.0, 0.0, 0.0)
    assert row.roc_auc == 1.0


def test_one_class_has_no_auc(spark):
    row = ev.evaluate(scored(spark, [(1, 0.9), (1, 0.2)])).first()
    assert row.roc_auc is None and row.precision == 1.0 and row.recall == 0.5


@pytest.mark.parametrize("bad", [(None, 0.3), (2, 0.3), (1, None), (1, float("nan"))])
def test_unusable_rows_are_an_error(spark, bad):
    with pytest.raises(ValueError, match="1 rows"):
        ev.evaluate(scored(spark, [(1, 0.2), (0, 0.1), bad]))


def test_confusion_counts_refuse_the_same_rows(spark):
    rows = scored(spark, [(1, 0.9), (0, None), (0, float("nan")), (1, 0.2)])
    with pytest.raises(ValueError, match="2 rows without a 0/1 label or without a score"):
        ev.confusion_counts(rows)


def test_confusion_and_metrics(spark):
    pairs = ties(200, seed=9)
    counts = ev.confusion_counts(scored(spark, pairs)).first()
    assert counts.tp == sum(y == 1 and s > 0.5 for y, s in pairs)
    assert counts.fp == sum(y == 0 and s > 0.5 for y, s in pairs)
    assert sum(counts) == 200


def metrics(spark, **values):
    row = {m: 0.5 for m in ev.METRICS} | values
    schema = ", ".join(f"{m} double" for m in ev.METRICS)
    return spark.createDataFrame([tuple(row[m] for m in ev.METRICS)], schema)


def test_any_metric_above_the_limit_is_an_improvement(spark):
    old = metrics(spark)
    mixed = ev.compare_metrics(old, metrics(spark, recall=0.502, accuracy=0.1))
    rows = {r.metric: r for r in mixed.collect()}
    assert rows["recall"].symbol == "✓" and rows["accuracy"].symbol == "✗"
    assert rows["f1_score"].symbol == "=" and rows["recall"].new_text == "0.5020"
    assert ev.any_improved(mixed).first().improved
    assert not ev.any_improved(ev.compare_metrics(old, metrics(spark, recall=0.5009))).first().improved


def expected(train, existing, compare, improved, force, updated):
    if updated:
        force, compare = True, False
    if not train:
        return False
    if existing and compare:
        return improved or force
    return force


def test_decision_table(spark):
    names = ["train", "existing", "compare", "improved", "force", "updated"]
    rows = list(product((False, True), repeat=6))
    df = spark.createDataFrame(rows, ", ".join(f"{n} boolean" for n in names))
    publish, reason = ev.decision(*[F.col(n) for n in names])
    for row in df.withColumns({"publish": publish, "reason": reason}).collect():
        assert row.publish == expected(*[row[n] for n in names]), row
    flags = ev.Flags(data_updated=True)
    assert flags.forces and not flags.compares
    assert decide(spark, flags, True, False) == (True, "forced without comparison")

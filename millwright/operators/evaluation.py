"""Classification metrics, comparison of two metric sets, promotion.

All metrics come from one table: positives and negatives per distinct score.
Building it is one aggregation with map-side combining, whatever number of
rows share a score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millwright.functions import conditions
from millwright.schema import TARGET, require_columns
from millwright.sources.scratch import scratch_tables

# Metric names in report order.
METRICS = ("accuracy", "precision", "recall", "f1_score", "roc_auc")

# Smallest change that counts as an improvement (exclusive).
IMPROVEMENT = 0.001

WINDOW_ROWS = 1_000_000


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient of two counts; 0.0 where the denominator is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0).cast("long"))


def _confusion(positives: Column, negatives: Column, flagged: Column) -> dict[str, Column]:
    """tp, fp, fn, tn as sums over (positives, negatives, predicted positive)."""
    zero = F.lit(0).cast("long")
    return {
        "tp": _total(F.when(flagged, positives).otherwise(zero)),
        "fp": _total(F.when(flagged, negatives).otherwise(zero)),
        "fn": _total(F.when(flagged, zero).otherwise(positives)),
        "tn": _total(F.when(flagged, zero).otherwise(negatives)),
    }


def _unusable(label: str, score: str) -> Column:
    """1 for a row without a 0/1 label or without a score, else 0."""
    usable = F.col(label).isin(0, 1) & F.col(score).isNotNull() & ~F.isnan(score)
    return F.when(usable, 0).otherwise(1).cast("long")


def _refuse(unusable: int) -> None:
    if unusable:
        raise ValueError(f"{unusable} rows without a 0/1 label or without a score")


def confusion_counts(
    scored: DataFrame, label: str = TARGET, score: str = "probability", threshold: float = 0.5
) -> DataFrame:
    """One row (tp, fp, fn, tn); a row is predicted positive when score > threshold.

    Raises if a label is not 0/1 or a score is missing, as :func:`evaluate` does.
    """
    counts = _confusion(
        (F.col(label) == 1).cast("long"), (F.col(label) == 0).cast("long"), F.col(score) > threshold
    )
    columns = [c.alias(n) for n, c in counts.items()]
    sums = scored.agg(*columns, _total(_unusable(label, score)).alias("unusable"))
    row = sums.first()
    _refuse(row.unusable)
    return scored.sparkSession.createDataFrame([tuple(row)], sums.schema).drop("unusable")


def threshold_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from confusion counts; 0.0 if undefined."""
    return counts.select(*[c.alias(n) for n, c in _threshold_columns().items()])


def _threshold_columns() -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))
    return {
        "accuracy": _ratio(tp + tn, tp + fp + fn + tn),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1_score": _ratio(2 * tp, 2 * tp + fp + fn),
    }


def score_counts(
    scored: DataFrame, label: str = TARGET, score: str = "probability"
) -> DataFrame:
    """(score, positives, negatives, unusable) per distinct score."""
    require_columns(scored, [label, score])
    return scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("positives"),
        F.sum((F.col(label) == 0).cast("long")).alias("negatives"),
        F.sum(_unusable(label, score)).alias("unusable"),
    )


def evaluate(
    scored: DataFrame,
    label: str = TARGET,
    score: str = "probability",
    threshold: float = 0.5,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """One row with the five metrics of :data:`METRICS`, computed at once.

    ROC-AUC is exact, with tied scores counting one half; it is NULL when only
    one class occurs.  Raises if a label is not 0/1 or a score is missing.
    """
    spark = scored.sparkSession
    with scratch_tables(spark) as tables:
        counts = tables.write(score_counts(scored, label, score), "score-counts")
        size = counts.agg(
            F.count(F.lit(1)).alias("scores"), _total(F.col("unusable")).alias("unusable")
        ).first()
        _refuse(size.unusable)
        ranked = _negatives_below(counts, size.scores, window_rows)
        # pairs won, doubled: each positive against the negatives below and tied
        pairs = F.col("positives").cast("decimal(19,0)") * (
            2 * F.col("below") + F.col("negatives")
        ).cast("decimal(19,0)")
        confusion = _confusion(F.col("positives"), F.col("negatives"), F.col("score") > threshold)
        sums = ranked.agg(
            *[c.alias(n) for n, c in confusion.items()], F.sum(pairs).alias("doubled_wins")
        )
        one_row = spark.createDataFrame([tuple(sums.first())], sums.schema)
    n_pairs = (F.col("tp") + F.col("fn")).cast("decimal(19,0)") * (
        F.col("fp") + F.col("tn")
    ).cast("decimal(19,0)")
    auc = F.try_divide(F.col("doubled_wins").cast("double"), (2 * n_pairs).cast("double"))
    columns = _threshold_columns() | {"roc_auc": auc}
    return one_row.select(*[c.alias(n) for n, c in columns.items()])


def roc_auc(
    scored: DataFrame,
    label: str = TARGET,
    score: str = "probability",
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """One row with the exact area under the ROC curve."""
    return evaluate(scored, label, score, window_rows=window_rows).select("roc_auc")


def _negatives_below(counts: DataFrame, n_scores: int, window_rows: int) -> DataFrame:
    """Adds the negatives with a smaller score.

    A running sum per score bucket plus the total of the buckets before.  The
    bucket edges are quantiles of the distinct scores, so the buckets are
    balanced however the scores are spread.
    """
    n_buckets = math.ceil(n_scores / max(window_rows, math.isqrt(n_scores)))
    edges: list[float] = []
    if n_buckets > 1:
        steps = [i / n_buckets for i in range(1, n_buckets)]
        edges = sorted(set(counts.approxQuantile("score", steps, 0.25 / n_buckets)))
    if not edges:
        bucketed = counts.withColumn("bucket", F.lit(0))
    else:
        splits = [float("-inf"), *edges, float("inf")]
        bucketed = Bucketizer(splits=splits, inputCol="score", outputCol="bucket").transform(counts)
    upto = W.partitionBy("bucket").orderBy("score").rowsBetween(W.unboundedPreceding, 0)
    running = bucketed.withColumn("below", F.sum("negatives").over(upto) - F.col("negatives"))
    if not edges:
        return running
    # a row per bucket, of which there are no more than the root of the scores
    totals = bucketed.groupBy("bucket").agg(F.sum("negatives").alias("in_bucket"))
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    offsets = totals.select(
        "bucket", (F.sum("in_bucket").over(before) - F.col("in_bucket")).alias("offset")
    )
    return running.join(F.broadcast(offsets), "bucket").withColumn(
        "below", F.col("below") + F.col("offset")
    )


def metrics_long(metrics: DataFrame) -> DataFrame:
    """(metric, value) rows from a one-row metrics table."""
    return metrics.unpivot([], list(METRICS), "metric", "value")


def compare_metrics(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Two one-row metric tables side by side, one row per metric."""
    before = metrics_long(existing).withColumnRenamed("value", "existing_value")
    after = metrics_long(new).withColumnRenamed("value", "new_value")
    diff = F.col("new_value") - F.col("existing_value")
    return (
        before.join(F.broadcast(after), "metric")  # five rows
        .withColumn("diff", diff)
        .withColumns({
            "symbol": conditions.change_symbol(F.col("diff")),
            "diff_text": conditions.change_text(F.col("diff")),
            "existing_text": conditions.metric_text(F.col("existing_value")),
            "new_text": conditions.metric_text(F.col("new_value")),
            "improved": F.coalesce(F.col("diff") > IMPROVEMENT, F.lit(False)),
        })
    )


def any_improved(comparison: DataFrame) -> DataFrame:
    """One row: did at least one metric rise by more than :data:`IMPROVEMENT`."""
    return comparison.agg(F.coalesce(F.bool_or("improved"), F.lit(False)).alias("improved"))


@dataclass(frozen=True)
class Flags:
    """The switches of a training run; a data update overrides two of them."""

    train: bool = True
    compare: bool = True
    force: bool = False
    data_updated: bool = False

    @property
    def compares(self) -> bool:
        return self.compare and not self.data_updated

    @property
    def forces(self) -> bool:
        return self.force or self.data_updated


def decision(
    trained: Column,
    has_existing: Column,
    compare: Column,
    improved: Column,
    force: Column,
    data_updated: Column,
) -> tuple[Column, Column]:
    """(publish, reason) of a training run; all inputs are boolean columns."""
    forces = force | data_updated
    compared = has_existing & compare & ~data_updated
    reason = (
        F.when(~trained, "not trained")
        .when(compared & improved, "improved")
        .when(compared & forces, "forced without improvement")
        .when(compared, "no improvement")
        .when(forces, "forced without comparison")
        .otherwise("not compared")
    )
    publish = trained & F.when(compared, improved | forces).otherwise(forces)
    return publish, reason

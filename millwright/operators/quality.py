"""Checks, counts and row-level quality of a readings table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.functions import bounds
from millwright.schema import FEATURES, SENSORS, TARGET, Sensor, require_columns

VIOLATIONS = "violations"
UNUSUAL = "unusual"


def project_features(
    df: DataFrame, features: Sequence[str] = FEATURES, target: str | None = TARGET
) -> DataFrame:
    """Feature columns in model order and the target; raises if any is absent."""
    wanted = [*features, target] if target else list(features)
    require_columns(df, wanted)
    return df.select(*wanted)


def schema_check(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column: is it there, and how many rows have a value."""
    present = set(df.columns)
    counts = [
        F.count(F.col(f"`{n}`")).alias(n) if n in present else F.lit(0).cast("long").alias(n)
        for n in required
    ]
    # count(*) keeps this one aggregation even if no required column is there
    counted = df.agg(F.count(F.lit(1)).alias("__rows"), *counts)
    rows = F.array(*[
        F.struct(
            F.lit(n).alias("column_name"),
            F.lit(n in present).alias("present"),
            F.col(f"`{n}`").alias("rows_with_value"),
        )
        for n in required
    ])
    return counted.select(F.inline(rows))


def table_profile(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).alias("column_count")
    )


def label_distribution(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Rows per class with their place, largest first; rows without a class are not counted."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    place = F.row_number().over(Window.orderBy(F.desc("rows"), label))  # one row per class
    return counts.withColumn("place", place).orderBy("place")


def split_distribution(df: DataFrame, label: str = TARGET, split: str = "split") -> DataFrame:
    """Rows per split and class."""
    return df.where(F.col(label).isNotNull()).groupBy(split, label).agg(
        F.count(F.lit(1)).alias("rows")
    )


def with_violations(df: DataFrame, sensors: Sequence[Sensor] = SENSORS) -> DataFrame:
    """Adds the names of sensors that are absent or outside the accepted range."""
    return df.withColumn(VIOLATIONS, bounds.violations(sensors))


def accepted_rows(df: DataFrame, sensors: Sequence[Sensor] = SENSORS) -> DataFrame:
    """Rows with every sensor inside its accepted range (pushed to the scan)."""
    return df.where(bounds.all_inside(sensors))


def quarantined_rows(df: DataFrame, sensors: Sequence[Sensor] = SENSORS) -> DataFrame:
    """The other rows, with the reason (the range test is pushed to the scan)."""
    return with_violations(df.where(bounds.any_refused(sensors)), sensors)


def learnable(features: Sequence[str] = FEATURES, label: str = TARGET) -> Column:
    """Whether a model can learn from a row: the class 0 or 1, every feature a number."""
    test = F.col(label).isin(0, 1)
    for name in features:
        test = test & F.col(name).isNotNull() & ~F.isnan(name)
    return test


def trainable(df: DataFrame, features: Sequence[str] = FEATURES, label: str = TARGET) -> DataFrame:
    """The rows that :func:`learnable` accepts."""
    return df.where(learnable(features, label))


def _per_sensor(df: DataFrame, tests: Sequence[tuple[str, object]], names: Sequence[str]) -> DataFrame:
    """Counts of true tests as one row per sensor, from a single aggregation."""
    counted = df.agg(*[
        F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0)).alias(f"{sensor}:{name}")
        for sensor, cells in tests
        for name, test in zip(names, cells, strict=True)
    ])
    rows = F.array(*[
        F.struct(
            F.lit(sensor).alias("sensor"), *[F.col(f"`{sensor}:{name}`").alias(name) for name in names]
        )
        for sensor, _ in tests
    ])
    return counted.select(F.inline(rows))


def violation_counts(df: DataFrame, sensors: Sequence[Sensor] = SENSORS) -> DataFrame:
    """Per sensor: rows with no value, rows outside the accepted range."""
    tests = [
        (s.name, (
            F.col(s.name).isNull() | F.isnan(s.name),
            F.col(s.name).isNotNull() & ~F.isnan(s.name) & ~bounds.accepted(s),
        ))
        for s in sensors
    ]
    return _per_sensor(df, tests, ("absent_rows", "outside_rows"))


def with_unusual(df: DataFrame, sensors: Sequence[Sensor] = SENSORS) -> DataFrame:
    """Adds the names of sensors outside their documented normal range."""
    return df.withColumn(UNUSUAL, bounds.unusual_names(sensors))


def unusual_counts(df: DataFrame, sensors: Sequence[Sensor] = SENSORS) -> DataFrame:
    """Per sensor: rows below and above the documented normal range."""
    tests = [
        (s.name, (
            bounds.unusual(s) & (F.col(s.name) < s.seen_low),
            bounds.unusual(s) & (F.col(s.name) > s.seen_high),
        ))
        for s in sensors
    ]
    return _per_sensor(df, tests, ("below_rows", "above_rows"))


def fill_defaults(df: DataFrame, sensors: Sequence[Sensor] = SENSORS) -> DataFrame:
    """Absent sensor values (NULL or NaN) replaced by the sensor's default."""
    return df.withColumns({
        s.name: F.coalesce(F.nanvl(F.col(s.name), F.lit(None).cast("double")), F.lit(s.default))
        for s in sensors
    })


def input_summary(
    df: DataFrame, keys: Sequence[str], features: Sequence[str] = FEATURES
) -> DataFrame:
    """One row per reading and sensor, as (keys, sensor, value)."""
    return df.unpivot(list(keys), list(features), "sensor", "value")

import pytest
from pyspark.sql import functions as F

from millwright.functions import conditions
from millwright.operators import advice, quality
from millwright.plans.scoring import score
from millwright.schema import FEATURES, SENSORS, TARGET, MissingColumnsError, require_columns, to_canonical

NORMAL = [791.0, 3.3, 6.7, 2.3, 77.6, 78.4]


def readings(spark, *rows):
    schema = ", ".join(f"{f} double" for f in FEATURES) + f", {TARGET} int"
    return spark.createDataFrame([(*r, 0) for r in rows], schema)


def changed(**values):
    return [values.get(f, v) for f, v in zip(FEATURES, NORMAL, strict=True)]


def test_defaults_are_accepted_and_normal(spark):
    assert [s.default for s in SENSORS] == NORMAL
    df = readings(spark, NORMAL)
    assert quality.accepted_rows(df).count() == 1
    assert quality.with_unusual(df).first().unusual == ""


@pytest.mark.parametrize("sensor", SENSORS, ids=lambda s: s.name)
def test_bounds_are_inclusive(spark, sensor):
    step = 1e-6
    values = [sensor.low, sensor.high, sensor.low - step, sensor.high + step, None, float("nan")]
    df = readings(spark, *[changed(**{sensor.name: v}) if v is not None else
                           [None if f == sensor.name else n for f, n in zip(FEATURES, NORMAL, strict=True)]
                           for v in values])
    assert quality.accepted_rows(df).count() == 2
    refused = quality.quarantined_rows(df).collect()
    assert [r.violations for r in refused] == [sensor.name] * 4
    counts = {r.sensor: r for r in quality.violation_counts(df).collect()}
    assert counts[sensor.name].absent_rows == 2 and counts[sensor.name].outside_rows == 2


def test_filter_reaches_the_scan(spark, folder):
    path = f"{folder}/r"
    readings(spark, NORMAL).write.parquet(path)
    kept = quality.accepted_rows(spark.read.parquet(path).select("engine_rpm", *FEATURES[1:]))
    plan = kept._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = plan.split("PushedFilters: ")[1].split("\n")[0]
    assert "GreaterThanOrEqual(engine_rpm,100.0)" in pushed



def test_quarantine_filter_reaches_the_scan(spark, folder):
    path = f"{folder}/r"
    readings(spark, NORMAL).write.parquet(path)
    refused = quality.quarantined_rows(spark.read.parquet(path).select("engine_rpm", *FEATURES[1:]))
    plan = refused._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = plan.split("PushedFilters: ")[1].split("\n")[0]
    assert "Or(" in pushed and "GreaterThan(engine_rpm" in pushed and "IsNull(coolant_temp)" in pushed

def test_fill_defaults_and_score(spark):
    gap = changed()
    gap[0], gap[2] = None, float("nan")
    df = readings(spark, gap)
    filled = quality.fill_defaults(df).first()
    assert (filled.engine_rpm, filled.fuel_pressure) == (791.0, 6.7)
    plain = score(df, F.lit(0.75)).first()
    assert not plain.accepted and plain.prediction is None and plain.condition is None
    assert plain.violations == "engine_rpm,fuel_pressure"
    row = score(df, F.lit(0.75), use_defaults=True).first()
    assert (row.prediction, row.condition) == (1, conditions.MAINTENANCE)
    assert (row.normal_percent, row.maintenance_percent) == ("25.00%", "75.00%")


def test_half_is_normal(spark):
    scored = score(readings(spark, NORMAL), F.lit(0.5))
    assert scored.first().condition == conditions.NORMAL
    assert [r.line_no for r in advice.recommendations(scored).orderBy("line_no").collect()] == [1, 2, 3, 4]
    assert advice.recommendations(score(readings(spark, NORMAL), F.lit(0.6))).count() == 6


def test_required_columns_match_case(spark):
    df = spark.createDataFrame([(1.0,)], "ENGINE_RPM double")
    with pytest.raises(MissingColumnsError) as error:
        require_columns(df, ["engine_rpm"])
    assert error.value.missing == ["engine_rpm"] and error.value.available == ["ENGINE_RPM"]
    headers = spark.createDataFrame([(1.0, 2)], "`Engine rpm` double, other int")
    assert to_canonical(headers).columns == ["engine_rpm", "other"]
    report = quality.schema_check(df, ["engine_rpm", "coolant_temp"]).collect()
    assert [(r.column_name, r.present, r.rows_with_value) for r in report] == [
        ("engine_rpm", False, 0), ("coolant_temp", False, 0)]


def test_profiles_and_distribution(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (None,)], "engine_condition int")
    assert [tuple(r) for r in quality.label_distribution(df).collect()] == [(1, 2, 1), (0, 1, 2)]
    assert tuple(quality.table_profile(df).first()) == (4, 1)
    assert quality.table_profile(df.limit(0)).first().row_count == 0


def test_summary_has_one_row_per_sensor(spark):
    df = readings(spark, NORMAL).withColumn("id", F.lit(9))
    rows = quality.input_summary(df, ["id"]).collect()
    assert {(r.id, r.sensor, r.value) for r in rows} == {(9, f, v) for f, v in zip(FEATURES, NORMAL, strict=True)}

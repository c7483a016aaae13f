"""Sensor-shaped tables derived from the driver's tables (see FIXTURES.md).

Each has a Spark form and a SQL form with the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.operators.splitting import stratified_split
from millwright.schema import FEATURES, TARGET, Sensor
from millwright.sources.scratch import materialize

KEY = "reading_id"
COLUMNS = [*FEATURES, TARGET]

# Bounds on the scale of the fixture: accepted, default, normal.
SENSORS = (
    Sensor("engine_rpm", "Engine rpm", 1.0e3, 1.0e5, 791.0, 2.0e3, 9.0e4),
    Sensor("lub_oil_pressure", "Lub oil pressure", 2.0, 49.0, 3.3, 5.0, 45.0),
    Sensor("fuel_pressure", "Fuel pressure", 0.0, 0.095, 6.7, 0.005, 0.085),
    Sensor("coolant_pressure", "Coolant pressure", 0.0, 0.075, 2.3, 0.005, 0.065),
    Sensor("lub_oil_temp", "lub oil temp", 1.0, 6.5, 77.6, 2.0, 6.0),
    Sensor("coolant_temp", "Coolant temp", 1.0, 30.0, 78.4, 2.0, 28.0),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per line item; ``src_key`` is not unique."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey src_key",
        "l_extendedprice engine_rpm",
        "l_quantity lub_oil_pressure",
        "l_discount fuel_pressure",
        "l_tax coolant_pressure",
        "cast(l_linenumber as double) lub_oil_temp",
        "cast(day(l_shipdate) as double) coolant_temp",
        "case when l_extendedprice / l_quantity > 2.0E3"
        " or (l_returnflag = 'R' and l_linestatus = 'F') then 1 else 0 end engine_condition",
    )


def keyed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per order, with the unique key ``reading_id``."""
    high = "l_extendedprice / l_quantity > 4.0E3 and l_returnflag = 'R'"
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias(KEY))
        .agg(
            F.max("l_extendedprice").alias("engine_rpm"),
            F.max("l_quantity").alias("lub_oil_pressure"),
            F.max("l_discount").alias("fuel_pressure"),
            F.max("l_tax").alias("coolant_pressure"),
            F.max("l_linenumber").cast("double").alias("lub_oil_temp"),
            F.count(F.lit(1)).cast("double").alias("coolant_temp"),
            F.max(F.expr(f"case when {high} then 1 else 0 end")).alias(TARGET),
        )
    )


def split_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed readings with their split, written once."""
    rows = materialize(keyed_readings(spark, sf_dir), "keyed-readings")
    return materialize(stratified_split(rows, key=[KEY]), "split-readings")


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = split_readings(spark, sf_dir)
    return tuple(rows.where(F.col("split") == part).drop("split") for part in ("train", "test"))


def base_and_batch(
    spark: SparkSession, sf_dir: str, keyed: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Overlapping tables, each with a tenth of the keys doubled."""
    rows = keyed_readings(spark, sf_dir) if keyed else readings(spark, sf_dir)
    key = KEY if keyed else "src_key"
    digit = F.col(key) % 10

    def doubled(part: DataFrame, at: int) -> DataFrame:
        copies = F.when(digit == at, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return part.withColumn("copy_no", F.explode(copies))

    base, batch = doubled(rows.where(digit < 8), 0), doubled(rows.where(digit >= 7), 9)
    kept = [KEY, *COLUMNS] if keyed else COLUMNS
    return base.select(kept), batch.select(kept)


def doubled_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All keyed readings, a tenth of them twice."""
    copies = F.when(F.col(KEY) % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = keyed_readings(spark, sf_dir).withColumn("copy_no", F.explode(copies))
    return rows.select(KEY, *COLUMNS)


def copies_keyed(base: DataFrame) -> DataFrame:
    """Adds ``copy_key``, unique per row, copies of a reading included."""
    copy_no = F.row_number().over(W.partitionBy(KEY).orderBy(KEY))  # two copies at most
    return base.withColumn("copy_key", F.col(KEY) * 10 + copy_no)


def gapped_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with absent values in two sensors."""
    return readings(spark, sf_dir).withColumns({
        "engine_rpm": F.when(F.col("src_key") % 17 != 0, F.col("engine_rpm")),
        "fuel_pressure": F.when(F.col("src_key") % 19 != 0, F.col("fuel_pressure")),
    })


def scorer_a() -> Column:
    return F.expr("floor(least(1.0E0, engine_rpm / lub_oil_pressure / 4.0E3) * 1.0E3) / 1.0E3")


def scorer_b() -> Column:
    return F.expr("floor(least(1.0E0, engine_rpm / 1.05E5) * 1.0E3) / 1.0E3")


def scorer_c() -> Column:
    """Five decimals, never a tie when rounded to four."""
    return F.expr(SCORER_C_SQL)


def scorer_gapped() -> Column:
    """Scorer A, which has no value where the engine speed is absent."""
    return F.when(F.col("engine_rpm").isNotNull(), scorer_a())


def file_schema(keyed: bool = False) -> T.StructType:
    """Columns of the readings files the stream queries write, in order."""
    headers = {s.name: s.header for s in SENSORS} | {TARGET: "Engine Condition"}
    fields = [T.StructField(headers[c], T.StringType()) for c in COLUMNS]
    return T.StructType(([T.StructField(KEY, T.LongType())] if keyed else []) + fields)


# ---- the same tables in SQL ------------------------------------------------

READINGS_SQL = """select l_orderkey src_key, l_extendedprice engine_rpm,
  l_quantity lub_oil_pressure, l_discount fuel_pressure, l_tax coolant_pressure,
  cast(l_linenumber as double) lub_oil_temp, cast(day(l_shipdate) as double) coolant_temp,
  case when l_extendedprice / l_quantity > 2.0E3
    or (l_returnflag = 'R' and l_linestatus = 'F') then 1 else 0 end engine_condition
from lineitem"""

KEYED_SQL = """select l_orderkey reading_id, max(l_extendedprice) engine_rpm,
  max(l_quantity) lub_oil_pressure, max(l_discount) fuel_pressure, max(l_tax) coolant_pressure,
  cast(max(l_linenumber) as double) lub_oil_temp, cast(count(*) as double) coolant_temp,
  max(case when l_extendedprice / l_quantity > 4.0E3 and l_returnflag = 'R' then 1 else 0 end)
    engine_condition
from lineitem group by l_orderkey"""

GAPPED_SQL = """select src_key, case when src_key % 17 <> 0 then engine_rpm end engine_rpm,
  lub_oil_pressure, case when src_key % 19 <> 0 then fuel_pressure end fuel_pressure,
  coolant_pressure, lub_oil_temp, coolant_temp, engine_condition
from f1"""

SCORER_A_SQL = "floor(least(1.0E0, engine_rpm / lub_oil_pressure / 4.0E3) * 1.0E3) / 1.0E3"
_FOUR = "floor(least(0.9999E0, engine_rpm / lub_oil_pressure / 4.0E3) * 1.0E4)"
SCORER_C_SQL = f"({_FOUR} * 1.0E1 + 3.0E0 + 4.0E0 * ({_FOUR} % 2)) / 1.0E5"
SCORER_B_SQL = "floor(least(1.0E0, engine_rpm / 1.05E5) * 1.0E3) / 1.0E3"

COLUMNS_SQL = ", ".join(COLUMNS)


def base_and_batch_sql(keyed: bool = False) -> str:
    """CTE text defining ``base`` and ``batch`` over ``f1`` (or ``f1k``)."""
    source, key = ("f1k", KEY) if keyed else ("f1", "src_key")
    kept = f"{KEY}, {COLUMNS_SQL}" if keyed else COLUMNS_SQL
    return f"""base as (select {kept} from {source} where {key} % 10 < 8
    union all select {kept} from {source} where {key} % 10 = 0),
  batch as (select {kept} from {source} where {key} % 10 >= 7
    union all select {kept} from {source} where {key} % 10 = 9)"""


DOUBLED_SQL = f"""doubled as (select {KEY}, {', '.join(COLUMNS)} from f1k
    union all select {KEY}, {', '.join(COLUMNS)} from f1k where {KEY} % 10 = 0)"""


def split_sql(source: str, label: str, key: str) -> str:
    """CTE text defining ``parts``: the rows of ``source`` with their split."""
    return f"""cls as (select {label} y, count(*) n from {source} group by {label}),
  tot as (select cast(sum(n) as bigint) n_all, cast(ceil(sum(n) * 0.2E0) as bigint) n_test from cls),
  shares as (select y, n * (n_all - n_test) // n_all whole, n * (n_all - n_test) % n_all rest,
    n_all - n_test n_train from cls cross join tot),
  ranked as (select *, row_number() over (order by rest desc, y) place, sum(whole) over () given
    from shares),
  quota as (select y, whole + case when place <= n_train - given then 1 else 0 end k from ranked),
  ordered as (select *, row_number() over (partition by {label}
    order by md5(concat('42:', cast({key} as varchar))), {key}) rn from {source}),
  parts as (select o.* exclude (rn), case when o.rn <= q.k then 'train' else 'test' end split
    from ordered o join quota q on o.{label} = q.y)"""


def with_sql(*ctes: str, select: str) -> str:
    known = {"f1": READINGS_SQL, "f1k": KEYED_SQL, "f5": GAPPED_SQL}
    parts = [f"{c} as ({known[c]})" if c in known else c for c in ctes]
    return "with " + ",\n  ".join(parts) + "\n" + select

"""Reading and writing tables of sensor readings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.schema import FEATURES, TARGET, to_canonical, to_headers

SPLIT = "split"

# Cell texts that mean "no value" in a readings file.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _number(name: str, kind: str) -> Column:
    """A text cell as a number; missing marks and unreadable text become NULL.

    ``+ 0.0`` turns a negative zero into zero, so equal readings look equal.
    """
    text = F.trim(F.col(name))
    value = F.when(~text.isin(*MISSING_TEXTS), text).try_cast("double")
    value = F.when(~F.isnan(value), value + F.lit(0.0))
    if kind == "double":
        return value
    return F.when(value == F.floor(value), value).try_cast(kind)


def parse_text_columns(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Canonical names and numeric types for an all-text table.

    ``types`` gives the type of further columns; the others stay text.
    """
    df = to_canonical(df)
    present = set(df.columns)
    typed = {n: _number(n, "double") for n in FEATURES if n in present}
    if TARGET in present:
        typed[TARGET] = _number(TARGET, "int")
    for name, kind in (types or {}).items():
        if name in present and name not in typed and kind != "string":
            text = F.trim(F.col(f"`{name}`"))
            typed[name] = F.when(~text.isin(*MISSING_TEXTS), text).try_cast(kind)
    return df.withColumns(typed)


def read_csv(
    spark: SparkSession, path: str | Sequence[str], types: Mapping[str, str] | None = None
) -> DataFrame:
    """CSV with a header line, columns taken by name.

    No type inference pass: cells are read as text and cast once.  With
    ``enforceSchema`` off, Spark checks each file's header against the first
    one's and fails on a mismatch instead of swapping columns.
    """
    paths = [path] if isinstance(path, str) else list(path)
    text = spark.read.option("header", True).option("enforceSchema", False).csv(paths)
    return parse_text_columns(text, types)


def write_csv(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """CSV with the original headers and no index column, replacing ``path``."""
    writer = to_headers(df).write.mode("overwrite").option("header", True)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)


def write_split_csv(df: DataFrame, path: str) -> None:
    """A table with a ``split`` column as ``split=train`` and ``split=test`` folders."""
    write_csv(df, path, partition_by=SPLIT)


def read_presplit_csv(
    spark: SparkSession, path: str, types: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Train and test table that :func:`write_split_csv` wrote."""
    return (
        read_csv(spark, f"{path}/{SPLIT}=train", types),
        read_csv(spark, f"{path}/{SPLIT}=test", types),
    )


def read_full_csv(
    spark: SparkSession, path: str, types: Mapping[str, str] | None = None
) -> DataFrame:
    """The whole dataset behind a split, train and test rows together, in one scan."""
    return read_csv(spark, path, types).drop(SPLIT)

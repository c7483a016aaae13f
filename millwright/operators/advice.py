"""Status and recommended actions for scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions import conditions as texts


def advice_table(spark: SparkSession) -> DataFrame:
    """The ten advice lines: (is_normal, line_no, status, advice)."""
    lines = [
        (normal, number, status, line)
        for normal, status, advice in (
            (True, texts.HEALTHY_STATUS, texts.HEALTHY_ADVICE),
            (False, texts.ACTION_STATUS, texts.ACTION_ADVICE),
        )
        for number, line in enumerate(advice, start=1)
    ]
    return spark.createDataFrame(lines, "is_normal boolean, line_no int, status string, advice string")


def recommendations(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """One row per scored row and advice line; unscored rows get none."""
    lines = F.broadcast(advice_table(scored.sparkSession))
    return scored.join(lines, (F.col(prediction) == 0) == F.col("is_normal")).drop("is_normal")

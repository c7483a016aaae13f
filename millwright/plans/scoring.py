"""The scoring job: check, predict, label, explain, for a whole table or stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions import bounds, conditions
from millwright.operators.quality import VIOLATIONS, fill_defaults
from millwright.operators.trees import PROBABILITY, with_probability
from millwright.schema import SENSORS, Sensor, require_columns

ACCEPTED = "accepted"


def score(
    df: DataFrame,
    scorer,
    sensors: Sequence[Sensor] = SENSORS,
    use_defaults: bool = False,
) -> DataFrame:
    """``df`` with the checks, the prediction and its texts.

    ``scorer`` is a fitted model or a column expression for P(class 1).  Rows
    that fail a check stay in the result with the reason, and without a
    prediction.  Every step is row by row, so this also takes a stream.
    """
    features = [s.name for s in sensors]
    require_columns(df, features)
    if use_defaults:
        df = fill_defaults(df, sensors)
    checked = df.withColumn(VIOLATIONS, bounds.violations(sensors)).withColumn(
        ACCEPTED, F.col(VIOLATIONS) == ""
    )
    if isinstance(scorer, Column):
        scored = checked.withColumn(PROBABILITY, scorer)
    else:
        scored = with_probability(scorer, checked, features)
    p = F.when(F.col(ACCEPTED), F.col(PROBABILITY))
    return scored.withColumn(PROBABILITY, p).withColumns({
        "prediction": conditions.predicted_class(F.col(PROBABILITY)),
        "normal_percent": conditions.percent_text(F.lit(1.0) - F.col(PROBABILITY)),
        "maintenance_percent": conditions.percent_text(F.col(PROBABILITY)),
    }).withColumn("condition", conditions.condition_text(F.col("prediction")))

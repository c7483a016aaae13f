"""Scoring of arriving readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millwright.plans.scoring import ACCEPTED, score
from millwright.schema import SENSORS, Sensor
from millwright.sources.registry import ModelRegistry

BATCH, MODEL_VERSION = "batch", "model_version"


def start_scoring(
    readings: DataFrame,
    scorer,
    output: str,
    checkpoint: str,
    sensors: Sequence[Sensor] = SENSORS,
    use_defaults: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append scored readings to a table partitioned into accepted and rejected.

    One pass without state; the file sink commits each batch exactly once.  The
    default trigger scores what is waiting and stops.
    """
    return (
        score(readings, scorer, sensors, use_defaults)
        .writeStream.format("parquet")
        .partitionBy(ACCEPTED)
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_registry_scoring(
    readings: DataFrame,
    registry: ModelRegistry,
    output: str,
    checkpoint: str,
    sensors: Sequence[Sensor] = SENSORS,
    use_defaults: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score each micro-batch with the model that is published when it begins.

    ``model_version`` says which one that was.  A batch is the folder ``batch=<id>`` of
    ``output``, which a retry writes again as a whole, with the then published model.
    The registry's log is asked once per batch and a model is loaded once per version.
    A stream without a published model fails and scores nothing.
    """
    loaded: dict[int, object] = {}

    def work(batch: DataFrame, batch_id: int) -> None:
        version = registry.current_version()
        if version is None:
            raise LookupError(f"no published model below {registry.root}")
        if version not in loaded:
            loaded.clear()
            version, model = registry.current()
            loaded[version] = model
        scored = score(batch, loaded[version], sensors, use_defaults).withColumn(MODEL_VERSION, F.lit(version).cast("long"))
        scored.write.mode("overwrite").partitionBy(ACCEPTED).parquet(f"{output}/{BATCH}={batch_id}")

    return (
        readings.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )

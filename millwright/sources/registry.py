"""Versioned models on a shared path.

``models/<n>-<id>/`` holds a fitted model, ``model_log/`` one row per published
version with its kind and test metrics, see millwright.sources.log.  The log row is
written last; of two writers each gets a version of its own.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millwright.operators.boosting import NewtonModel
from millwright.operators.evaluation import METRICS
from millwright.sources.log import ATTEMPTS, Conflict, VersionLog

_LOG = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("reason", T.StringType()),
    *[T.StructField(m, T.DoubleType()) for m in METRICS],
    T.StructField("test_rows", T.LongType()),
    T.StructField("unusable_test_rows", T.LongType()),
    T.StructField("unusable_train_rows", T.LongType()),
    T.StructField("data_version", T.LongType()),
    T.StructField("folder", T.StringType()),
])


def save_model(spark: SparkSession, model, path: str) -> str:
    """Write a model, replacing what is at ``path``; returns its kind."""
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
        return "spark_ml"
    model.save(spark, path)
    return "newton"


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._log = VersionLog(spark, f"{self.root}/model_log", _LOG)

    def log(self) -> DataFrame:
        """One row per published version with its test metrics."""
        return self._log.rows()

    def current(self):
        """(version, model) of the last published model, or None."""
        last = self._log.last()
        if last is None:
            return None
        path = f"{self.root}/models/{last['folder']}"
        if last["kind"] == "spark_ml":
            return last["version"], PipelineModel.load(path)
        return last["version"], NewtonModel.load(self.spark, path)

    def current_version(self) -> int | None:
        """The number of the last published model, without the model."""
        last = self._log.last()
        return None if last is None else last["version"]

    def data_version(self) -> int | None:
        """The version of the rows that the last published model learned from."""
        last = self._log.last()
        return None if last is None else last["data_version"]

    def publish(
        self, model, metrics: dict, reason: str,
        unusable_train_rows: int | None = None, data_version: int | None = None,
    ) -> int:
        version = (-1 if (last := self.current_version()) is None else last) + 1
        folder = f"{version:08d}-{uuid.uuid4().hex[:8]}"
        kind = save_model(self.spark, model, f"{self.root}/models/{folder}")
        row = {
            "kind": kind, "reason": reason, **{m: metrics.get(m) for m in METRICS}, "test_rows": metrics.get("test_rows"),
            "unusable_test_rows": metrics.get("unusable_test_rows"), "unusable_train_rows": unusable_train_rows,
            "data_version": data_version, "folder": folder,
        }
        for _ in range(ATTEMPTS):
            try:
                self._log.commit({"version": version, **row})
                return version
            except Conflict:
                version = self.current_version() + 1
        raise Conflict(f"{self.root}: a model that {ATTEMPTS} others have overtaken")

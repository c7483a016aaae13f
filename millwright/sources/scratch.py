"""Intermediate tables in the shared folder of the cluster.

An intermediate that several jobs read is written once as parquet below
``spark.checkpoint.dir``.  That cuts its lineage and survives the loss of any
executor, which cached blocks and local checkpoints do not.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"

#: Bytes of a split, and rows of a shuffled partition, that a task may hold.
SPLIT_BYTES = 32 << 20
ROWS_PER_TASK = 1 << 20
#: Rows of a narrow table that are worth a file.
ROWS_PER_FILE = 1 << 16
_SPLITS = "spark.sql.files.maxPartitionBytes"
_PARTITIONS = "spark.sql.shuffle.partitions"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder; a fresh temporary one only on a local master."""
    configured = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{SETTING} must name a shared folder on a cluster")
    own = tempfile.mkdtemp(prefix="millwright-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set(SETTING, own)
    return own


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` and Spark ML at the shared folder."""
    root = scratch_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once; the table read back, and its path for :func:`discard`."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def in_few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of narrow rows, some ``rows`` at most, in as many partitions as they are worth, but two a core.

    Else a small table behind a shuffle is a file for every partition that has a row of it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(2 * cores, -(-rows // ROWS_PER_FILE)))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back."""
    return written(df, name)[0]


@contextmanager
def bounded_tasks(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is written in the block is read and shuffled in tasks that hold a bounded part of some ``rows``.

    Grouping holds the distinct rows of a task, so splits are at most ``SPLIT_BYTES``, and
    a shuffle has a partition for every ``ROWS_PER_TASK`` rows.
    """
    bytes_ = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_SPLITS)))
    bounds = {
        _SPLITS: min(bytes_, SPLIT_BYTES),
        _PARTITIONS: max(int(spark.conf.get(_PARTITIONS)), -(-rows // ROWS_PER_TASK)),
    }
    before = {name: spark.conf.get(name) for name in bounds}
    try:
        for name, value in bounds.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class Scratch:
    """Tables of one job; see :func:`scratch_tables`."""

    def __init__(self, spark: SparkSession, reader: SparkSession | None = None):
        self.spark = spark
        self.reader = reader or spark  # the session that reads what is written
        self._paths: list[str] = []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and read it back."""
        path = fresh_path(self.spark, name)
        self._paths.append(path)  # a failed write leaves files too
        df.write.parquet(path)
        return self.reader.read.schema(df.schema).parquet(path)

    def replace(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and delete the tables before it, which only it has read."""
        before, self._paths = self._paths, []
        try:
            return self.write(df, name)
        finally:
            for path in before:
                discard(self.spark, path)

    def clear(self) -> None:
        """Delete all tables written so far."""
        while self._paths:
            discard(self.spark, self._paths.pop())


@contextmanager
def scratch_tables(spark: SparkSession, reader: SparkSession | None = None) -> Iterator[Scratch]:
    """Tables that are deleted when the block ends, by an error too.

    For intermediates only: what a lazy result still reads is for :func:`materialize`.
    """
    tables = Scratch(spark, reader)
    try:
        yield tables
    finally:
        tables.clear()


def located(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    system, target = located(spark, path)
    system.delete(target, True)


def size_on_disk(spark: SparkSession, path: str) -> int:
    """Bytes of the files below ``path``."""
    system, target = located(spark, path)
    return system.getContentSummary(target).getLength()


def as_named(path: Column) -> Column:
    """A path of ``_metadata``, which comes percent-encoded, as it is in the file system."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def children(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is no such folder."""
    system, target = located(spark, path)
    if not system.exists(target):
        return []
    return [str(found.getPath()) for found in system.listStatus(target)]

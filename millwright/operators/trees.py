"""Boosted-tree classifier on Spark ML, and scoring with any fitted model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.operators.quality import project_features, trainable
from millwright.schema import FEATURES, TARGET, require_columns
from millwright.sources.scratch import Scratch, ensure_checkpoint_dir, scratch_tables

# The tuned training parameters.
N_TREES = 250
MAX_DEPTH = 6
LEARNING_RATE = 0.01
ROW_SAMPLE = 0.8
COLUMN_SAMPLE = 0.6
GAMMA = 0.5
ALPHA = 0.5
LAMBDA = 7.0
MIN_CHILD_WEIGHT = 10.0
SEED = 42

MAX_BINS = 256
# a row weighs at most 1/4 (p(1-p)), so weight 10 takes at least 40 rows
MIN_ROWS = int(4 * MIN_CHILD_WEIGHT)

ROWS_PER_TASK = 1 << 16  # that are worth a task
TASK_ROWS = 1 << 21  # most rows of a task, whose file is then one split
WAITING = 1.25  # rows that a pass may wait for, of those it waits for where they lie evenly

PROBABILITY = "probability"
_VECTOR = "__features"


def gbt_pipeline(
    features: Sequence[str] = FEATURES, label: str = TARGET, n_trees: int = N_TREES, **changes
) -> Pipeline:
    """The training preset; ``changes`` override single Spark ML parameters.

    Spark ML has no L1/L2 or gain penalty (see ``boosting`` for these), samples
    columns per node instead of per tree, and gives the first tree weight 1.
    """
    settings = {
        "maxIter": n_trees,
        "maxDepth": MAX_DEPTH,
        "stepSize": LEARNING_RATE,
        "subsamplingRate": ROW_SAMPLE,
        "featureSubsetStrategy": str(COLUMN_SAMPLE),
        "minInstancesPerNode": MIN_ROWS,
        "maxBins": MAX_BINS,
        "seed": SEED,
        "lossType": "logistic",
        "checkpointInterval": 10,
    } | changes
    # "keep" lets rows with gaps through; scoring blanks their result
    assembler = VectorAssembler(
        inputCols=list(features), outputCol=_VECTOR, handleInvalid="keep"
    )
    # private names: a scored table can be scored again
    trees = GBTClassifier(featuresCol=_VECTOR, labelCol=label, predictionCol="__class", **settings)
    trees.setRawPredictionCol("__raw").setProbabilityCol("__chance")
    return Pipeline(stages=[assembler, trees])


def train_gbt(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = TARGET,
    n_trees: int = N_TREES,
    **changes,
) -> PipelineModel:
    """Fit the preset on the rows that have every feature and a 0/1 class."""
    ensure_checkpoint_dir(train.sparkSession)
    rows = trainable(project_features(train, features, label), features, label)
    with scratch_tables(train.sparkSession) as tables:
        return gbt_pipeline(features, label, n_trees, **changes).fit(_evenly(tables, rows))


def _evenly(tables: Scratch, rows: DataFrame) -> DataFrame:
    """``rows`` as they lie, or written evenly where each pass over them would wait for the fullest tasks.

    Spark ML passes over all rows for every level of every tree, so a partition more than
    there are cores is waited for as often.  The rows are written, as Spark ML counts on
    meeting them in the same order when a lost block is made again, and sorted, as a
    shuffle brings them in any order.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    held = [r.n for r in rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    n_rows = sum(held)
    parts = min(-(-n_rows // ROWS_PER_TASK), cores * -(-n_rows // (cores * TASK_ROWS)))

    def waited(most: int, tasks: int) -> int:
        return most * -(-tasks // cores)

    if not held or waited(max(held), len(held)) <= WAITING * waited(-(-n_rows // parts), parts):
        return rows
    return tables.write(rows.repartition(parts).sortWithinPartitions(*rows.columns), "gbt-rows")


def takes_gaps(model) -> bool:
    """Whether a model scores rows with absent features."""
    return getattr(model, "takes_gaps", False)


def with_probability(model, df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Adds P(class 1), or replaces an earlier one; works on batch and streaming tables."""
    require_columns(df, features)
    if not isinstance(model, PipelineModel):
        return model.transform(df)
    kept = [F.col(f"`{c}`") for c in df.columns if c != PROBABILITY]
    chance = model.stages[-1].getProbabilityCol()
    scored = model.transform(df.drop(PROBABILITY))
    return scored.select(*kept, vector_to_array(F.col(chance))[1].alias(PROBABILITY))


def feature_importances(model: PipelineModel, features: Sequence[str] = FEATURES) -> dict:
    return dict(zip(features, model.stages[-1].featureImportances.toArray().tolist(), strict=True))

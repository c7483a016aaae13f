"""Spark side: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import hashlib
import inspect
import os
import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.operators import advice, boosting, evaluation, merging, quality, quantiles, splitting, trees
from millwright.plans.preparation import prepare
from millwright.plans.scoring import score
from millwright.plans.training import evaluate_model, train_and_promote
from millwright.schema import FEATURES, TARGET
from millwright.sources import readings as files
from millwright.sources.registry import ModelRegistry
from millwright.sources.scratch import SETTING, fresh_path, materialize, scratch_root
from millwright.sources.store import DatasetStore
from millwright.streaming.ingest import ingest, read_csv_stream
from millwright.streaming.scoring import start_registry_scoring, start_scoring
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Trees of the trained models; fewer only in tests.
N_TREES = trees.N_TREES


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# ---- sources and sinks -----------------------------------------------------


@query
def scan_presplit(spark, sf_dir):
    path = fresh_path(spark, "presplit")
    files.write_split_csv(fx.split_readings(spark, sf_dir), path)
    train, test = files.read_presplit_csv(spark, path, {fx.KEY: "bigint"})
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )


@query
def scan_full(spark, sf_dir):
    path = fresh_path(spark, "full")
    files.write_split_csv(fx.split_readings(spark, sf_dir), path)
    return files.read_full_csv(spark, path, {fx.KEY: "bigint"})


@query
def write_split_roundtrip(spark, sf_dir):
    store = DatasetStore(spark, fresh_path(spark, "store"))
    store.publish_split(fx.split_readings(spark, sf_dir))
    return store.read_split("train").unionByName(store.read_split("test"))


# ---- projections, checks, flags ---------------------------------------------


@query
def project_features(spark, sf_dir):
    return quality.project_features(fx.readings(spark, sf_dir))


@query
def schema_check(spark, sf_dir):
    rows = fx.gapped_readings(spark, sf_dir).drop("coolant_temp")
    return quality.schema_check(rows, [*FEATURES, TARGET])


@query
def table_profile(spark, sf_dir):
    return quality.table_profile(fx.readings(spark, sf_dir).select(fx.COLUMNS))


@query
def label_distribution(spark, sf_dir):
    return quality.label_distribution(fx.readings(spark, sf_dir))


@query
def accepted_rows(spark, sf_dir):
    return quality.accepted_rows(fx.gapped_readings(spark, sf_dir), fx.SENSORS)


@query
def quarantine_rows(spark, sf_dir):
    return quality.quarantined_rows(fx.gapped_readings(spark, sf_dir), fx.SENSORS)


@query
def quarantine_counts(spark, sf_dir):
    return quality.violation_counts(fx.gapped_readings(spark, sf_dir), fx.SENSORS)


@query
def range_flags(spark, sf_dir):
    return quality.with_unusual(fx.gapped_readings(spark, sf_dir), fx.SENSORS)


@query
def range_flag_counts(spark, sf_dir):
    return quality.unusual_counts(fx.gapped_readings(spark, sf_dir), fx.SENSORS)


@query
def fill_defaults(spark, sf_dir):
    return quality.fill_defaults(fx.gapped_readings(spark, sf_dir), fx.SENSORS)


@query
def input_summary(spark, sf_dir):
    return quality.input_summary(fx.keyed_readings(spark, sf_dir), [fx.KEY])


# ---- merging ------------------------------------------------------------------


@query
def union_all(spark, sf_dir):
    return merging.union_all(*fx.base_and_batch(spark, sf_dir))


@query
def merge_distinct(spark, sf_dir):
    return merging.merge_distinct(*fx.base_and_batch(spark, sf_dir))


@query
def duplicates_removed(spark, sf_dir):
    return merging.duplicates_removed(*fx.base_and_batch(spark, sf_dir))


@query
def merge_report(spark, sf_dir):
    return merging.merge_report(*fx.base_and_batch(spark, sf_dir))


@query
def merged_label_distribution(spark, sf_dir):
    return quality.label_distribution(merging.merge_distinct(*fx.base_and_batch(spark, sf_dir)))


@query
def new_rows(spark, sf_dir):
    return merging.new_rows(*fx.base_and_batch(spark, sf_dir))


@query
def new_rows_distinct_base(spark, sf_dir):
    base, batch = fx.base_and_batch(spark, sf_dir)
    stored = materialize(base.dropDuplicates(), "distinct-base")
    return merging.new_rows(stored, batch, base_is_distinct=True)


@query
def new_rows_large_batch(spark, sf_dir):
    """A batch beyond the broadcast: the base is scanned through the batch's Bloom filter."""
    base, batch = fx.base_and_batch(spark, sf_dir)
    stored = materialize(base.dropDuplicates(), "distinct-base")
    return merging.new_rows(stored, batch, base_is_distinct=True, broadcast_bytes=0)


@query
def stream_ingest_segments(spark, sf_dir):
    """Three batches, of which each meets only the files that may hold its rows."""
    base, batch = fx.base_and_batch(spark, sf_dir)
    store = DatasetStore(spark, fresh_path(spark, "store"))
    third = F.col("lub_oil_temp").cast("int") % 3
    for digit in range(3):
        store.merge(base.where(third == digit), f"part-{digit}")
    store.merge(batch, "batch")
    return store.read()


def _written_inbox(spark, rows: DataFrame) -> str:
    inbox = fresh_path(spark, "inbox")
    files.write_csv(rows, inbox)
    return inbox


@query
def stream_ingest_merge(spark, sf_dir):
    base, batch = fx.base_and_batch(spark, sf_dir)
    store = DatasetStore(spark, fresh_path(spark, "store"))
    store.create(base)
    ingest(store, _written_inbox(spark, batch), fx.file_schema())
    return store.read()


@query
def stream_ingest_incremental(spark, sf_dir):
    """Into a table known to be distinct only the new rows are written."""
    base, batch = fx.base_and_batch(spark, sf_dir)
    store = DatasetStore(spark, fresh_path(spark, "store"))
    store.create(base, dedupe=True)
    ingest(store, _written_inbox(spark, batch), fx.file_schema())
    return store.read()


_HEADERS = [f.name for f in fx.file_schema().fields]


def _part(rows: DataFrame, order: list[str], inbox: str, digit: int) -> None:
    """One slice of a batch as files whose columns are ``order``."""
    files.to_headers(rows.where(F.col("src_key") % 3 == digit)).select(*order).write.mode(
        "append").option("header", True).csv(inbox)


@query
def stream_ingest_headers(spark, sf_dir):
    """Files with the usual header, with another order, and with one more column."""
    rows = fx.readings(spark, sf_dir).withColumn("Unit", F.concat(F.lit("u"), F.col("src_key") % 7))
    inbox = fresh_path(spark, "inbox")
    _part(rows, _HEADERS, inbox, 0)
    _part(rows, _HEADERS[::-1], inbox, 1)
    _part(rows, ["Unit", *_HEADERS], inbox, 2)
    store = DatasetStore(spark, fresh_path(spark, "store"))
    ingest(store, inbox, fx.file_schema())
    return store.read()


@query
def stream_ingest_breaks(spark, sf_dir):
    """Files with a column of quoted notes, of which some have line breaks and quotes."""
    note = F.when(F.col("src_key") % 3 == 0, F.concat(F.lit("u"), F.col("src_key") % 7, F.lit('\nsaid "on",\nend'))).otherwise("plain, so")
    rows = files.to_headers(fx.readings(spark, sf_dir).withColumn("Note", note)).select("Note", *_HEADERS)
    inbox = fresh_path(spark, "inbox")
    rows.write.options(header=True, escape='"').csv(inbox)
    store = DatasetStore(spark, fresh_path(spark, "store"))
    ingest(store, inbox, fx.file_schema())
    return store.read()


def _spoilt(spark, sf_dir) -> DataFrame:
    """Readings as cells of text, some of which no reading has."""
    rows = fx.readings(spark, sf_dir)
    key = F.col("src_key")
    return rows.select(
        "src_key",
        F.when(key % 23 == 0, F.lit("n/a")).when(key % 29 == 0, F.lit("fast")).otherwise(
            F.col("engine_rpm").cast("string")).alias("Engine rpm"),
        *[F.col(s.name).cast("string").alias(s.header) for s in fx.SENSORS[1:]],
        F.when(key % 31 == 0, F.lit("")).when(key % 37 == 0, F.lit("2")).when(key % 41 == 0, F.lit("bad"))
        .otherwise(F.col(TARGET).cast("string")).alias("Engine Condition"))


def _write_short(rows: DataFrame, inbox: str) -> None:
    """Lines that lack their last cell, below the full header, in a file per task."""
    cells = F.concat_ws(",", *[F.col(h) for h in _HEADERS[:-1]])
    rows.select(cells.alias(",".join(_HEADERS))).write.mode("append").option("header", True).option(
        "sep", "\x01").csv(inbox)  # the line is one cell


def _ingest_spoilt(spark, sf_dir) -> DatasetStore:
    """Bad labels, unreadable sensors, and files of rows that lack their last cell."""
    rows, inbox = _spoilt(spark, sf_dir), fresh_path(spark, "inbox")
    short = F.col("src_key") % 43 == 0
    rows.where(~short).select(*_HEADERS).write.option("header", True).csv(inbox)
    _write_short(rows.where(short), inbox)
    store = DatasetStore(spark, fresh_path(spark, "store"))
    ingest(store, inbox, fx.file_schema())
    return store


@query
def stream_ingest_quarantine(spark, sf_dir):
    """The rows that a spoilt batch leaves usable."""
    return _ingest_spoilt(spark, sf_dir).read()


@query
def stream_ingest_rejects(spark, sf_dir):
    """The others, counted by reason."""
    rejects = _ingest_spoilt(spark, sf_dir).rejects()
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("raw").alias("raws"))


@query
def stream_ingest_archive(spark, sf_dir):
    """The files of merged batches, as they are read in the archive."""
    base, batch = fx.base_and_batch(spark, sf_dir)
    store = DatasetStore(spark, fresh_path(spark, "store"))
    inbox, archive = fresh_path(spark, "inbox"), fresh_path(spark, "archive")
    for rows in (base, batch):
        files.to_headers(rows).write.mode("append").option("header", True).csv(inbox)
        ingest(store, inbox, fx.file_schema(), archive)
    moved = spark.read.option("header", True).option("recursiveFileLookup", True).csv(archive)
    return files.parse_text_columns(moved).distinct()


# ---- splitting ------------------------------------------------------------------


@query
def stratified_split(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return splitting.stratified_split(events, "event_type", ["event_id"])


@query
def stratified_split_readings(spark, sf_dir):
    return fx.split_readings(spark, sf_dir)


@query
def split_distribution(spark, sf_dir):
    return quality.split_distribution(fx.split_readings(spark, sf_dir))


@query
def split_leakage(spark, sf_dir):
    """Copies of a reading under keys of their own can land on both sides."""
    rows = materialize(fx.copies_keyed(fx.doubled_readings(spark, sf_dir)), "copies")
    return splitting.split_leakage(splitting.stratified_split(rows, key=["copy_key"]).drop("copy_key"))


@query
def prepare_presplit(spark, sf_dir):
    store = DatasetStore(spark, fresh_path(spark, "store"))
    store.publish_split(fx.split_readings(spark, sf_dir))
    return prepare(store, "presplit").rows


@query
def prepare_merge(spark, sf_dir):
    base, batch = fx.base_and_batch(spark, sf_dir, keyed=True)
    store = DatasetStore(spark, fresh_path(spark, "store"))
    store.create(base)
    inbox = fresh_path(spark, "inbox")
    files.write_csv(batch, inbox)
    return prepare(store, "merge", inbox, fx.file_schema(keyed=True), key=[fx.KEY]).rows


@query
def prepare_resplit(spark, sf_dir):
    store = DatasetStore(spark, fresh_path(spark, "store"))
    store.create(fx.doubled_readings(spark, sf_dir))
    return prepare(store, "resplit", key=[fx.KEY]).rows


# ---- evaluation ------------------------------------------------------------------


def _scored(spark, sf_dir, scorer) -> DataFrame:
    return fx.readings(spark, sf_dir).select(TARGET, scorer.alias("probability"))


@query
def confusion_counts(spark, sf_dir):
    return evaluation.confusion_counts(_scored(spark, sf_dir, fx.scorer_b()))


@query
def threshold_metrics(spark, sf_dir):
    counts = evaluation.confusion_counts(_scored(spark, sf_dir, fx.scorer_b()))
    return evaluation.threshold_metrics(counts)


@query
def roc_auc(spark, sf_dir):
    return evaluation.roc_auc(_scored(spark, sf_dir, fx.scorer_a()))


@query
def roc_auc_bucketed(spark, sf_dir):
    rows = fx.readings(spark, sf_dir).select(
        TARGET, (F.col("engine_rpm") / F.lit(1.05e5)).alias("probability")
    )
    return evaluation.roc_auc(rows, window_rows=1_000)


@query
def evaluate_scores(spark, sf_dir):
    return evaluation.metrics_long(evaluation.evaluate(_scored(spark, sf_dir, fx.scorer_a())))


class _Given:
    """A scorer in a model's place."""

    def __init__(self, chance, takes_gaps: bool):
        self.chance, self.takes_gaps = chance, takes_gaps

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("probability", self.chance)


@query
def evaluate_with_gaps(spark, sf_dir):
    """Metrics, rows used and rows left out, without gaps and with a scorer that takes them."""
    rows = fx.gapped_readings(spark, sf_dir)
    strict = evaluate_model(_Given(fx.scorer_a(), False), rows).withColumn("gaps", F.lit("left out"))
    filled = F.when(F.col("engine_rpm").isNull(), 0.25).otherwise(fx.scorer_a())
    return strict.unionByName(evaluate_model(_Given(filled, True), rows).withColumn("gaps", F.lit("scored")))


@query
def compare_models(spark, sf_dir):
    return _comparison(spark, sf_dir, fx.scorer_b(), fx.scorer_a())


def _comparison(spark, sf_dir, *scorers) -> DataFrame:
    existing, new = (evaluation.evaluate(_scored(spark, sf_dir, s)) for s in scorers)
    return evaluation.compare_metrics(existing, new)


@query
def promotion_decision(spark, sf_dir):
    """The outcome of a better and of a worse model under every setting of the switches."""
    names = ("trained", "has_existing", "compare", "force", "data_updated")
    settings = F.array(*[
        F.struct(*[F.lit(v).alias(n) for n, v in zip(names, values, strict=True)])
        for values in product((False, True), repeat=len(names))
    ])
    scorers = fx.scorer_b(), fx.scorer_a()
    improved = evaluation.any_improved(_comparison(spark, sf_dir, *scorers)).unionByName(
        evaluation.any_improved(_comparison(spark, sf_dir, *reversed(scorers))))
    rows = improved.select("improved", F.inline(settings))
    publish, reason = evaluation.decision(
        F.col("trained"), F.col("has_existing"), F.col("compare"), F.col("improved"),
        F.col("force"), F.col("data_updated"),
    )
    return rows.withColumns({"publish": publish, "reason": reason})


# ---- scoring ------------------------------------------------------------------


@query
def score_batch(spark, sf_dir):
    return score(fx.gapped_readings(spark, sf_dir), fx.scorer_c(), fx.SENSORS)


@query
def score_with_defaults(spark, sf_dir):
    rows = fx.gapped_readings(spark, sf_dir)
    return score(rows, fx.scorer_a(), fx.SENSORS, use_defaults=True)


@query
def recommendations(spark, sf_dir):
    scored = score(fx.keyed_readings(spark, sf_dir), fx.scorer_a(), fx.SENSORS)
    return advice.recommendations(scored.select(fx.KEY, "prediction", "condition"))


@query
def stream_score(spark, sf_dir):
    inbox = fresh_path(spark, "inbox")
    files.write_csv(fx.keyed_readings(spark, sf_dir), inbox)
    stream = read_csv_stream(spark, inbox, fx.file_schema(keyed=True))
    output = fresh_path(spark, "scored")
    start_scoring(
        stream, fx.scorer_a(), output, f"{output}-checkpoint", fx.SENSORS
    ).awaitTermination()
    return spark.read.schema(score(stream, fx.scorer_a(), fx.SENSORS).schema).parquet(output)


def _stumps(*values: float) -> boosting.NewtonModel:
    """Two given trees of one cut each, by speed and by oil pressure."""
    tree, (a, b, c, d) = boosting.Tree, values
    return boosting.NewtonModel(list(FEATURES), 0.25, 1, [
        tree([0, -1, -1], [0, 0, 0], [4.0e4, 0.0, 0.0], [0.0, a, b]),
        tree([1, -1, -1], [0, 0, 0], [25.0, 0.0, 0.0], [0.0, c, d]),
    ])


@query
def stream_score_promoted(spark, sf_dir):
    """A stream in two runs, the second after another model was published; probabilities to three places."""
    rows, inbox, output = fx.keyed_readings(spark, sf_dir), fresh_path(spark, "inbox"), fresh_path(spark, "scored")
    registry = ModelRegistry(spark, fresh_path(spark, "registry"))
    schema = fx.file_schema(keyed=True)
    for turn, model in enumerate((_stumps(-0.5, 0.75, 1.0, -1.25), _stumps(0.5, -0.25, -1.5, 0.5))):
        registry.publish(model, {}, "given")
        files.to_headers(rows.where(F.col(fx.KEY) % 2 == turn)).write.mode("append").option("header", True).csv(inbox)
        stream = read_csv_stream(spark, inbox, schema)
        start_registry_scoring(stream, registry, output, f"{output}-checkpoint", fx.SENSORS).awaitTermination()
    scored = spark.read.parquet(output)
    return scored.select(
        fx.KEY, "model_version", "prediction", F.expr("floor(probability * 1.0E3) / 1.0E3").alias("probability"))


# ---- models ------------------------------------------------------------------


# bins of a given width per feature, as many as a feature may have
_EDGES = {
    "engine_rpm": [3.5e3 * i for i in range(1, 250)],
    "lub_oil_pressure": [2.0 * i for i in range(1, 250)],
    "fuel_pressure": [i / 250 for i in range(1, 250)],
}


@query
def split_gain(spark, sf_dir):
    """Every cut of the first tree's root, by the trainer."""
    names, params = list(_EDGES), boosting.BoostParams()
    cuts = boosting.root_cuts(fx.readings(spark, sf_dir), names, TARGET, params, list(_EDGES.values()))
    rows = [
        (names[at], bin_, float(cuts.gain[0, at, bin_]))
        for at, bin_ in zip(*np.nonzero(np.isfinite(cuts.gain[0])), strict=True)
    ]
    return spark.createDataFrame([(f, int(b), g) for f, b, g in rows], "feature string, bin int, gain double")


@query
def curvature_quantiles(spark, sf_dir):
    """The values at each sixteenth of the curvature that a scorer leaves, for sensors of few values (exact there)."""
    chance = F.round(fx.scorer_a() * 1000)
    names, steps = list(FEATURES[1:]), [k / 16 for k in range(1, 16)]
    found = quantiles.summaries(fx.readings(spark, sf_dir), names, chance * (1000 - chance))
    rows = [(n, k, v) for n, s in zip(names, found, strict=True) for k, v in enumerate(quantiles.quantiles(s, steps), 1)]
    return spark.createDataFrame(rows, "feature string, step int, value double")


@query
def first_tree(spark, sf_dir):
    """The trainer's first tree from one half, two levels deep, on every row and column."""
    params = boosting.BoostParams(n_trees=1, max_depth=2, row_sample=1.0, column_sample=1.0)
    model = boosting.train_newton(
        fx.readings(spark, sf_dir), list(_EDGES), params=params, edges=list(_EDGES.values()), start=0.0)
    tree = model.trees[0]
    rows = [
        (node, model.features[tree.feature[node]], tree.cut[node], tree.gain[node],
         tree.value[2 * node + 1], tree.value[2 * node + 2])
        for node in range(3) if tree.feature[node] >= 0
    ]
    return spark.createDataFrame(
        rows, "node int, feature string, bin int, gain double, left_value double, right_value double")


@query
def score_tree_model(spark, sf_dir):
    """Two given stumps over every reading; probabilities to three places."""
    scored = _stumps(-0.5, 0.75, 1.0, -1.25).transform(fx.readings(spark, sf_dir))
    return scored.withColumns({
        "prediction": F.when(F.col("probability") > 0.5, 1).otherwise(0),
        "probability": F.expr("floor(probability * 1.0E3) / 1.0E3"),
    })


def _trained(spark, sf_dir, trainer) -> ModelRegistry:
    """Where the models of a trainer for the readings of ``sf_dir`` are kept, for later sessions too.

    Other input files, parameters or code of the trainers have a place of their own.
    """
    files_ = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct().collect()
    sources = [inspect.getsource(module) for module in (boosting, trees, fx)]
    key = repr((trainer.__name__, N_TREES, sorted(map(tuple, files_)), sources))
    root = spark.sparkContext.getConf().get(SETTING)
    if root is None:
        scratch_root(spark)  # raises on a cluster; that of a local session goes with it
        root = f"{tempfile.gettempdir()}/millwright-{os.getuid()}"
    return ModelRegistry(spark, f"{root}/trained/{hashlib.sha256(key.encode()).hexdigest()[:24]}")


def _fitted(spark, sf_dir, trainer, train):
    """A model that is trained here and now, and kept."""
    model = trainer(train)
    _trained(spark, sf_dir, trainer).publish(model, {}, "trained")
    return model


def _model(spark, sf_dir, trainer, train):
    """The kept model; one is trained only where there is none yet."""
    current = _trained(spark, sf_dir, trainer).current()
    return _fitted(spark, sf_dir, trainer, train) if current is None else current[1]


def _both_models(spark, train):
    """Models of both trainers, trained here and now whatever is kept; they share the cluster.

    A tree level is a short job that leaves most of the time to Spark's bookkeeping, and
    the next one waits for it: two trainers side by side take little longer than one.
    """
    @inheritable_thread_target(spark)
    def model(trainer):
        return trainer(train)

    with ThreadPoolExecutor(2) as pool:
        return list(pool.map(model, (_gbt, _newton)))


def _gbt(train):
    return trees.train_gbt(train, n_trees=N_TREES)


def _newton(train):
    return boosting.train_newton(train, params=boosting.BoostParams(n_trees=N_TREES), key=[fx.KEY])


@query
def train_gbt(spark, sf_dir):
    importances = trees.feature_importances(_fitted(spark, sf_dir, _gbt, fx.train_test(spark, sf_dir)[0]))
    return spark.createDataFrame(list(importances.items()), "feature string, importance double")


@query
def score_gbt(spark, sf_dir):
    train, test = fx.train_test(spark, sf_dir)
    return score(test, _model(spark, sf_dir, _gbt, train), fx.SENSORS)


@query
def evaluate_gbt(spark, sf_dir):
    train, test = fx.train_test(spark, sf_dir)
    return evaluate_model(_model(spark, sf_dir, _gbt, train), test)


@query
def train_newton(spark, sf_dir):
    return _fitted(spark, sf_dir, _newton, fx.train_test(spark, sf_dir)[0]).tree_table(spark)


@query
def score_newton(spark, sf_dir):
    train, test = fx.train_test(spark, sf_dir)
    return score(test, _model(spark, sf_dir, _newton, train), fx.SENSORS)


@query
def evaluate_newton(spark, sf_dir):
    train, test = fx.train_test(spark, sf_dir)
    return evaluate_model(_model(spark, sf_dir, _newton, train), test)


def _promoted(spark, train, test, first, second) -> DataFrame:
    """The log of a registry after a first model and one of updated data went through promotion."""
    registry = ModelRegistry(spark, fresh_path(spark, "registry"))
    train_and_promote(train, test, registry, evaluation.Flags(force=True), lambda *_: first, data_version=1)
    train_and_promote(train, test, registry, evaluation.Flags(), lambda *_: second, data_version=2)
    return registry.log()


@query
def promote_model(spark, sf_dir):
    """Publish a first model, then one of updated data; what the registry's log says but for the metrics."""
    train, test = fx.train_test(spark, sf_dir)
    return _promoted(spark, train, test, *_both_models(spark, train)).select(
        "version", "kind", "reason", "test_rows", "unusable_test_rows", "unusable_train_rows", "data_version")


@query
def model_facts(spark, sf_dir):
    """What holds for any fitted model: its trees, the rows it scores, chances between 0 and 1."""
    train, rows = fx.train_test(spark, sf_dir)
    models, facts = _both_models(spark, train), []
    for name, model in zip(("gbt", "newton"), models, strict=True):
        n_trees = len(model.trees) if name == "newton" else model.stages[-1].getNumTrees
        chance = F.col("probability").between(0, 1)
        found = trees.with_probability(model, rows).select(
            F.lit(name).alias("trainer"), F.lit(n_trees).cast("long").alias("n_trees"), chance.alias("chance"))
        facts.append(found.groupBy("trainer", "n_trees").agg(
            F.count(F.lit(1)).alias("scored_rows"), F.count_if("chance").alias("chances")))
    first_reason = _promoted(spark, train, rows, *models).orderBy("version").first().reason
    return facts[0].unionByName(facts[1]).withColumn("first_reason", F.lit(first_reason))

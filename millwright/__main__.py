"""The jobs as commands for spark-submit: ``prepare``, ``train``, ``score``.

    python -m millwright prepare --store /lake/readings --mode merge --inbox /landing
    python -m millwright train --store /lake/readings --registry /lake/models
    python -m millwright score --registry /lake/models --input /lake/today --output /lake/scored
    python -m millwright score --stream --registry /lake/models --input /lake/inbox --output /lake/scored
    python -m millwright vacuum --store /lake/readings
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millwright.operators.boosting import train_newton
from millwright.operators.evaluation import Flags
from millwright.operators.quality import split_distribution
from millwright.operators.trees import train_gbt
from millwright.plans.preparation import MODES, prepare
from millwright.plans.scoring import score
from millwright.plans.training import train_and_promote
from millwright.schema import header_schema
from millwright.sources.readings import read_csv, write_split_csv
from millwright.sources.registry import ModelRegistry
from millwright.sources.scratch import children
from millwright.sources.store import DatasetStore
from millwright.streaming.ingest import MAX_FILES, read_csv_stream
from millwright.streaming.scoring import start_registry_scoring


def _read(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """A table of parquet, or of CSV if it says so or its files are called so."""
    if kind is None:
        names = [path, *children(spark, path)]
        kind = "csv" if any(n.endswith((".csv", ".csv.gz")) for n in names) else "parquet"
    return read_csv(spark, path) if kind == "csv" else spark.read.parquet(path)


def _inbox_schema(columns: str | None) -> T.StructType | None:
    """The standard headers and the further columns of an inbox, as ``name type, ...``."""
    if columns is None:
        return None
    return T.StructType([*T.StructType.fromDDL(columns).fields, *header_schema().fields])


def _prepare(spark: SparkSession, args: argparse.Namespace) -> dict:
    store = DatasetStore(spark, args.store)
    if args.create:
        store.create(_read(spark, args.create, args.format))
    done = prepare(
        store, args.mode, args.inbox, _inbox_schema(args.inbox_columns), args.archive, key=args.key,
        publish=args.publish, dedupe=args.dedupe, max_files=args.max_files,
    )
    if args.export:
        write_split_csv(done.rows, args.export)
    counts = [r.asDict() for r in split_distribution(done.rows).collect()]
    return {
        "merged": done.merged, "published": done.published, "rows": counts,
        "rejected": done.rejected, "unclassed": done.unclassed,
    }


def _vacuum(spark: SparkSession, args: argparse.Namespace) -> dict:
    return {"deleted": DatasetStore(spark, args.store).vacuum(args.keep)}


def _train(spark: SparkSession, args: argparse.Namespace) -> dict:
    store = DatasetStore(spark, args.store)
    flags = Flags(not args.no_train, not args.no_compare, args.force, args.data_updated)

    def newton(rows: DataFrame, features: Sequence[str], label: str) -> object:
        return train_newton(rows, features, label, key=args.key)

    run = train_and_promote(
        store.read_split("train"), store.read_split("test"), ModelRegistry(spark, args.registry),
        flags, newton if args.trainer == "newton" else train_gbt, save_path=args.save,
        data_version=store.published_data_version(),
    )
    return {
        "existing": run.existing_metrics, "new": run.new_metrics, "publish": run.publish,
        "reason": run.reason, "version": run.version, "data_updated": run.data_updated,
        "unusable_train_rows": run.unusable_train_rows,
    }


def _score(spark: SparkSession, args: argparse.Namespace) -> dict:
    registry = ModelRegistry(spark, args.registry)
    if args.stream:
        rows = read_csv_stream(spark, args.input, header_schema(labelled=False), max_files=args.max_files)
        checkpoint = args.checkpoint or f"{args.output}-checkpoint"
        start_registry_scoring(rows, registry, args.output, checkpoint, use_defaults=args.defaults).awaitTermination()
        return {"model": registry.current_version(), "output": args.output}
    current = registry.current()
    if current is None:
        raise LookupError(f"no published model below {args.registry}")
    rows = score(_read(spark, args.input, args.format), current[1], use_defaults=args.defaults)
    rows.write.mode("overwrite").parquet(args.output)
    return {"model": current[0], "output": args.output}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millwright")
    jobs = top.add_subparsers(required=True)
    job = jobs.add_parser("prepare")
    job.set_defaults(run=_prepare)
    job.add_argument("--store", required=True)
    job.add_argument("--mode", choices=MODES, default="presplit")
    job.add_argument("--create", help="readings to start the store with")
    job.add_argument("--format", choices=("csv", "parquet"), help="of --create; default: by its files")
    job.add_argument("--inbox")
    job.add_argument("--inbox-columns", help="further columns of the inbox, as 'name type, ...'")
    job.add_argument("--max-files", type=int, default=MAX_FILES, help="files of one batch")
    job.add_argument("--archive")
    job.add_argument("--key", nargs="*")
    job.add_argument("--publish", action="store_true")
    job.add_argument("--dedupe", action="store_true")
    job.add_argument("--export", help="also write the split here as CSV folders")
    job = jobs.add_parser("train")
    job.set_defaults(run=_train)
    job.add_argument("--store", required=True)
    job.add_argument("--registry", required=True)
    job.add_argument("--trainer", choices=("gbt", "newton"), default="gbt")
    job.add_argument("--key", nargs="*", help="columns that decide which rows a tree samples")
    job.add_argument("--save", help="also write the run's model here")
    for flag in ("--no-train", "--no-compare", "--force", "--data-updated"):
        job.add_argument(flag, action="store_true")
    job = jobs.add_parser("score")
    job.set_defaults(run=_score)
    job.add_argument("--registry", required=True)
    job.add_argument("--input", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--format", choices=("csv", "parquet"), help="of --input; default: by its files")
    job.add_argument("--defaults", action="store_true", help="fill absent sensor values")
    job.add_argument("--stream", action="store_true", help="score the CSV files waiting in --input, each once")
    job.add_argument("--checkpoint", help="of the stream; default: next to --output")
    job.add_argument("--max-files", type=int)
    job = jobs.add_parser("vacuum")
    job.set_defaults(run=_vacuum)
    job.add_argument("--store", required=True)
    job.add_argument("--keep", type=int, default=2, help="versions that stay readable")
    return top


def main(arguments: list[str] | None = None) -> dict:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("millwright").getOrCreate()
    report = args.run(spark, args)
    print(json.dumps(report))
    return report


if __name__ == "__main__":
    main(sys.argv[1:])

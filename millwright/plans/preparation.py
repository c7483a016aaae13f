"""The data preparation job: use the published split, merge, or split again."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.operators.splitting import SEED, TEST_SIZE, stratified_split
from millwright.schema import TARGET
from millwright.sources.store import DatasetStore
from millwright.streaming.ingest import MAX_FILES, ingest

MODES = ("presplit", "merge", "resplit")


@dataclass
class Prepared:
    rows: DataFrame  # with the split column
    merged: bool  # were batches merged since the split published before
    published: int | None  # version of the split written by this run
    rejected: int = 0  # arriving rows that this run kept back, see DatasetStore.rejects
    unclassed: int = 0  # stored rows without a class, which no split has


def prepare(
    store: DatasetStore,
    mode: str = "presplit",
    inbox: str | None = None,
    inbox_schema: T.StructType | None = None,
    archive: str | None = None,
    label: str = TARGET,
    key: Sequence[str] | None = None,
    publish: bool = False,
    dedupe: bool = False,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    max_files: int = MAX_FILES,
) -> Prepared:
    """Run one preparation.

    ``presplit`` reads the published split.  ``merge`` first merges the files
    waiting in ``inbox``, ``max_files`` at a time; if batches were merged since the
    last published split, by this run or by one that ended before it published, the
    new split is published even with ``publish`` off.  Merged files move to
    ``archive`` if one is named.  ``merge`` without new files and ``resplit`` split
    the current rows; ``dedupe`` drops duplicate rows first (a merge always does).
    Stored rows without a class are counted and in no split.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is not one of {MODES}")
    if mode == "presplit":
        return Prepared(store.read_split(), merged=False, published=None)
    merged, rejected = False, 0
    if mode == "merge":
        if inbox is None:
            raise ValueError("mode 'merge' needs an inbox")
        rejected = ingest(store, inbox, inbox_schema, archive, max_files=max_files, label=label).rejected
        merged = store.unpublished_merge()
    current = store.current()
    if current is None:
        raise LookupError(f"no rows below {store.root}")
    if dedupe and not current.is_distinct:
        current = store.create(store.read(current), dedupe=True, tag="dedupe")
    stored = store.read(current)
    unclassed = stored.where(F.col(label).isNull()).count()
    rows = stratified_split(stored.where(F.col(label).isNotNull()), label, key, test_size, seed)
    if not (merged or publish):
        return Prepared(rows, merged, None, rejected, unclassed)
    version = store.publish_split(rows)
    return Prepared(store.read_split(version=version), merged, version, rejected, unclassed)

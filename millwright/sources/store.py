"""A versioned table of readings on a shared path.

Layout below ``root``::

    rows/<segment>/        parquet, never changed once committed
    filters/<segment>/     Bloom filter of the segment's rows: a bucket a row, with its file
    rejects/tag=<tag>/     rows that a batch could not use, with their reason
    splits/<version>-<id>/ parquet partitioned by ``split``
    log/                   the committed versions, see millwright.sources.log
    split_log/             the published splits

A version is a list of segments.  Merging a batch into a table that is known to
be free of duplicates adds one segment with the new rows only, so the cost of
writing follows the batch and not the table.  Segments of similar size are
compacted when there are several, so a row is written again once per size tier
and not once per batch.  Rows of one filter bucket lie in one file, so a batch that
is merged reads the filters, some two bytes a row, and of the rows only the files
that may hold some of its own.  The log row is written last: data without a log row is
invisible, and :meth:`DatasetStore.vacuum` deletes it.  Several writers may commit:
one that another has overtaken merges again into the newer version.  Readers are
never disturbed until :meth:`DatasetStore.vacuum` deletes what old versions read.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.operators import bloom
from millwright.operators.merging import absent_rows, distinct_batch, merge_distinct
from millwright.sources.log import ATTEMPTS, Conflict, VersionLog
from millwright.sources.readings import SPLIT
from millwright.sources.scratch import Scratch, as_named, bounded_tasks, children, discard, scratch_tables, size_on_disk

#: Segments of one size tier that are compacted into one; a tier is this many times the one below.
TIER_SEGMENTS = 8
#: Segments below this size are one tier.
TIER_BYTES = 1 << 20

#: Files of a segment that are named one by one; of more, all are read.
LISTED_FILES = 1_000

CREATE, MERGE, COMPACT = "create", "merge", "compact"

_LOG = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("segments", T.ArrayType(T.StringType())),
    T.StructField("row_schema", T.StringType()),
    T.StructField("is_distinct", T.BooleanType()),
    T.StructField("tag", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("filters", T.ArrayType(T.StructType([
        T.StructField("segment", T.StringType()),
        T.StructField("buckets", T.LongType()),
        T.StructField("kinds", T.MapType(T.StringType(), T.StringType())),
    ]))),
])
_FILTER = "bucket long, file string, rows long, words array<bigint>"
_REJECTS = "file string, raw string, reason string, tag string"
_SPLIT_LOG = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("data_version", T.LongType()),
    T.StructField("folder", T.StringType()),
])


@dataclass(frozen=True)
class Filter:
    segment: str
    buckets: int
    kinds: dict[str, str]  # see millwright.operators.bloom


@dataclass(frozen=True)
class Holding:
    """Where a version may hold some of the rows that were asked about."""

    paths: tuple[str, ...]  # files, and folders of segments without a filter for such rows
    hits: DataFrame | None  # (hash) of the rows that may be there; None: any of them


@dataclass(frozen=True)
class Version:
    number: int
    segments: tuple[str, ...]
    schema: T.StructType
    is_distinct: bool
    tag: str
    filters: tuple[Filter, ...] = ()  # of the segments that have one


class DatasetStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = VersionLog(spark, f"{self.root}/log", _LOG, ("version", "is_distinct", "tag", "kind"))
        self.split_log = VersionLog(spark, f"{self.root}/split_log", _SPLIT_LOG)

    # ---- versions -------------------------------------------------------

    def versions(self) -> DataFrame:
        """One row per version; those long past keep version, is_distinct, tag and kind."""
        return self.log.rows()

    def current(self) -> Version | None:
        row = self.log.last()
        if row is None:
            return None
        schema = T.StructType.fromJson(json.loads(row["row_schema"]))
        filters = tuple(Filter(**f) for f in row["filters"] or ())
        return Version(row["version"], tuple(row["segments"]), schema, row["is_distinct"], row["tag"], filters)

    def has_merged(self, tag: str) -> bool:
        return not self.versions().where(F.col("tag") == tag).isEmpty()

    def read(self, version: Version | None = None) -> DataFrame:
        """All rows of a version (default: the current one); absent columns are NULL."""
        version = version or self.current()
        if version is None:
            raise LookupError(f"no committed version below {self.root}")
        paths = [f"{self.root}/rows/{s}" for s in version.segments]
        return self.spark.read.schema(version.schema).parquet(*paths)

    def create(self, rows: DataFrame, dedupe: bool = False, tag: str = "create") -> Version:
        """Commit ``rows`` as the next version, replacing the earlier contents."""
        return self._retried(lambda: self._create(rows, dedupe, tag))

    def _create(self, rows: DataFrame, dedupe: bool, tag: str) -> Version:
        current = self.current()
        if dedupe:
            return self._commit_segment(current, rows.dropDuplicates(), (), True, tag, CREATE, rows.count())
        return self._commit_segment(current, rows, (), False, tag, CREATE)

    def merge(self, batch: DataFrame, tag: str) -> Version:
        """Commit current rows and ``batch`` without duplicate rows.

        ``tag`` names the batch: merging the same tag again changes nothing, so
        a retried micro-batch is harmless.  A batch of known rows commits its tag
        and no segment.  If another writer commits meanwhile, the batch is held against
        the newer version, so no row is lost or stored twice.
        """
        version = self._retried(lambda: self._merge(batch, tag))
        return self.compact() or version

    def _retried(self, work: Callable[[], Version]) -> Version:
        for attempt in range(ATTEMPTS):
            try:
                return work()
            except Conflict:
                if attempt + 1 == ATTEMPTS:
                    raise

    def _merge(self, batch: DataFrame, tag: str) -> Version:
        current = self.current()
        if current is None:
            return self._commit_segment(None, batch.dropDuplicates(), (), True, tag, MERGE, batch.count())
        if self.has_merged(tag):
            return current
        base = self.read(current)
        if not current.is_distinct:
            most = base.count() + batch.count()
            return self._commit_segment(current, merge_distinct(base, batch), (), True, tag, MERGE, most)
        with scratch_tables(self.spark) as tables:
            rows = tables.write(distinct_batch(base, batch), "distinct-batch")
            added = self._absent(current, rows, tables)
            return self._commit_segment(current, added, current.segments, True, tag, MERGE, rows.count())

    # ---- what a batch has to be held against ----------------------------

    def holding(self, version: Version, rows: DataFrame, tables: Scratch) -> Holding:
        """The files of ``version`` that may hold some of ``rows``, by the filters of its segments."""
        asked = [f for f in version.filters if bloom.comparable(f.kinds, bloom.kinds(rows.schema))]
        known = {f.segment for f in asked}
        rest = tuple(f"{self.root}/rows/{s}" for s in version.segments if s not in known)
        if not asked:
            return Holding(rest, None)
        filters = self.spark.read.schema(_FILTER).parquet(*[f"{self.root}/filters/{f.segment}" for f in asked])
        filters = filters.select(
            F.regexp_extract(as_named(F.col("_metadata.file_path")), ".*/filters/([^/]+)/", 1).alias("segment"), "bucket", "file", "words")
        hash_ = F.col("__hash")
        # segments with as many buckets are asked with one row
        sizes = sorted({f.buckets for f in asked})
        size = F.create_map(*[F.lit(x) for f in asked for x in (f.segment, f.buckets)])
        hashed = rows.select(bloom.row_hash(rows.schema).alias("__hash")).distinct()
        placed = hashed.select("__hash", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("__buckets")).withColumn(
            "__bucket", bloom.bucket(hash_, F.col("__buckets")))
        met = placed.join(
            filters.withColumn("__size", F.element_at(size, F.col("segment"))),
            (F.col("__bucket") == F.col("bucket")) & (F.col("__buckets") == F.col("__size")))
        hits = tables.write(met.where(bloom.may_hold(hash_)).select("__hash", "segment", "file").distinct(), "filter-hits")
        many = hits.groupBy("segment").agg(F.countDistinct("file").alias("n")).collect()
        few = [r.segment for r in many if r.n <= LISTED_FILES]
        paths = [f"{self.root}/rows/{r.segment}" for r in many if r.n > LISTED_FILES]
        listed = hits.where(F.col("segment").isin(few)).select("segment", "file").distinct().collect() if few else []
        paths += [f"{self.root}/rows/{r.segment}/{r.file}" for r in listed]
        return Holding((*rest, *sorted(paths)), None if rest else hits.select("__hash").distinct())

    def _absent(self, version: Version, rows: DataFrame, tables: Scratch) -> DataFrame:
        """The distinct, written ``rows`` that ``version`` does not have."""
        found = self.holding(version, rows, tables)
        if not found.paths:
            return rows
        stored = self.spark.read.schema(version.schema).parquet(*found.paths)
        if found.hits is None:
            return absent_rows(stored, rows)
        marked = rows.withColumn("__row", bloom.row_hash(rows.schema))
        same = F.col("__row") == F.col("__hash")
        doubtful = tables.write(marked.join(found.hits, same, "left_semi").drop("__row"), "doubtful-rows")
        sure = marked.join(found.hits, same, "left_anti").drop("__row")
        return sure.unionByName(absent_rows(stored, doubtful))

    def _commit_segment(
        self, current: Version | None, rows: DataFrame, kept: tuple[str, ...], is_distinct: bool, tag: str, kind: str,
        most: int = 0,
    ) -> Version:
        """Write ``rows``, ``most`` at most, as a segment and commit it behind those ``kept``, next after ``current``."""
        number = 0 if current is None else current.number + 1
        segment = f"{number:08d}-{tag}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/rows/{segment}"
        buckets = bloom.buckets_for(most)
        if is_distinct:
            rows = rows.repartition(bloom.bucket(bloom.row_hash(rows.schema), buckets))
        with bounded_tasks(self.spark, most):
            rows.write.mode("overwrite").parquet(path)
        schema = _nullable(rows.schema)
        filters = tuple(f for f in (current.filters if current else ()) if f.segment in kept)
        if kept and self.spark.read.schema(schema).parquet(path).isEmpty():
            discard(self.spark, path)
            schema, segments = current.schema, kept
        else:
            segments = (*kept, segment)
            if is_distinct:
                with bounded_tasks(self.spark, most):
                    self._write_filter(segment, schema, buckets)
                filters = (*filters, Filter(segment, buckets, bloom.kinds(schema)))
        row = (number, list(segments), schema.json(), is_distinct, tag, kind, [asdict(f) for f in filters])
        try:
            self.log.commit(dict(zip(_LOG.names, row, strict=True)))
        except Conflict:
            discard(self.spark, path)
            discard(self.spark, f"{self.root}/filters/{segment}")
            raise
        return Version(number, segments, schema, is_distinct, tag, filters)

    def _write_filter(self, segment: str, schema: T.StructType, buckets: int) -> None:
        """The filter of a segment that is written, from its files."""
        stored = self.spark.read.schema(schema).parquet(f"{self.root}/rows/{segment}")
        named = stored.withColumn("file", F.col("_metadata.file_name"))
        found = bloom.build(named, bloom.row_hash(schema), buckets, by=("file",))
        found.select("bucket", "file", "rows", "words").write.mode("overwrite").parquet(f"{self.root}/filters/{segment}")

    def compact(self, tier_segments: int = TIER_SEGMENTS) -> Version | None:
        """Commit a version in which a tier's small segments are one; None if no tier has enough.

        Only the segments of that tier are read and written.
        """
        current = self.current()
        tiers: dict[int, list[str]] = {}
        for segment in current.segments:
            size = size_on_disk(self.spark, f"{self.root}/rows/{segment}")
            tiers.setdefault(int(math.log(max(size, TIER_BYTES) / TIER_BYTES, tier_segments)), []).append(segment)
        full = [t for t in sorted(tiers) if len(tiers[t]) >= tier_segments]
        if not full:
            return None
        merged = tiers[full[0]]
        rows = self.spark.read.schema(current.schema).parquet(*[f"{self.root}/rows/{s}" for s in merged])
        kept = tuple(s for s in current.segments if s not in set(merged))
        try:
            return self._commit_segment(current, rows, kept, current.is_distinct, "compact", COMPACT, rows.count())
        except Conflict:
            return None  # the next merge finds the tier full again

    def vacuum(self, keep_versions: int = 2, keep_splits: int = 2) -> int:
        """Delete segments and splits that only older versions use; returns how many.

        The logs stay.  Do not run it while an older version is being read.
        """
        if keep_versions < 1 or keep_splits < 1:
            raise ValueError("the current version must stay")
        last = self.versions().where("segments is not null").orderBy(F.desc("version")).limit(keep_versions).collect()
        used = {segment for row in last for segment in row.segments}
        newest = max((row.version for row in last), default=-1)
        stale = self._unused("rows", used, newest)
        splits = self.split_log.rows().orderBy(F.desc("version")).limit(keep_splits).collect()
        stale += self._unused("splits", {row.folder for row in splits}, max((row.version for row in splits), default=-1))
        for path in stale + self._unused("filters", used, newest):
            discard(self.spark, path)
        return len(stale)

    def _unused(self, folder: str, used: set[str], newest: int) -> list[str]:
        """What is neither used nor being written: a writer names its folder by a version that is not there yet."""
        named = {path: path.rsplit("/", 1)[1] for path in children(self.spark, f"{self.root}/{folder}")}
        return [path for path, name in named.items() if name not in used and int(name.split("-", 1)[0]) <= newest]

    # ---- rejected rows ----------------------------------------------------

    def reject(self, rows: DataFrame, tag: str) -> int:
        """Keep the (file, raw, reason) of a batch's unusable rows; returns how many."""
        path = f"{self.root}/rejects/tag={tag}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path).count()

    def rejects(self) -> DataFrame:
        """(file, raw, reason, tag) of all rows that no batch could use."""
        try:
            return self.spark.read.schema(_REJECTS).parquet(f"{self.root}/rejects")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _REJECTS)

    # ---- splits ---------------------------------------------------------

    def current_split(self) -> int | None:
        last = self.split_log.last()
        return None if last is None else last["version"]

    def publish_split(self, rows: DataFrame) -> int:
        """Write a table with a ``split`` column and make it the current split."""
        data = self.current()
        last = self.current_split()
        number = 0 if last is None else last + 1
        folder = f"{number:08d}-{uuid.uuid4().hex[:8]}"
        rows.write.partitionBy(SPLIT).parquet(f"{self.root}/splits/{folder}")
        for _ in range(ATTEMPTS):
            try:
                self.split_log.commit({
                    "version": number, "data_version": None if data is None else data.number, "folder": folder})
                return number
            except Conflict:  # what was written is the split of the next version
                number = self.current_split() + 1
        raise Conflict(f"{self.root}: a split that {ATTEMPTS} others have overtaken")

    def unpublished_merge(self) -> bool:
        """Whether a batch was merged since the last published split."""
        last = self.published_data_version()
        merged = self.versions().where(F.col("kind") == MERGE)
        return not merged.where(F.col("version") > (-1 if last is None else last)).isEmpty()

    def published_data_version(self) -> int | None:
        """The version of the rows behind the current split."""
        last = self.split_log.last()
        return None if last is None else last["data_version"]

    def read_split(self, part: str | None = None, version: int | None = None) -> DataFrame:
        """The current split; with ``part`` only that partition's files are read."""
        last = self.split_log.last() if version is None else (
            self.split_log.rows().where(F.col("version") == version).first())
        if last is None:
            raise LookupError(f"no published split below {self.root}")
        rows = self.spark.read.parquet(f"{self.root}/splits/{last['folder']}")
        return rows if part is None else rows.where(F.col(SPLIT) == part)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])

"""Incremental merge of arriving reading files into a dataset store.

The stream lists files; each batch reads its files itself, because files name
their columns in a header of their own.  Files with the same header are one read,
and the reads are joined by column name.  Rows that cannot be used are told apart
before anything is committed and kept with their reason, so one bad file stops
neither the batch nor the next ones.
"""

from __future__ import annotations

import csv
import hashlib
import json
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.schema import FEATURES, HEADERS, TARGET, header_schema
from millwright.sources.readings import MISSING_TEXTS, parse_text_columns
from millwright.sources.log import put_if_absent, text_of
from millwright.sources.scratch import as_named, children, discard, located, scratch_tables
from millwright.sources.store import DatasetStore
from millwright.streaming.lines import Split, rows_of_lines, same_file, splits, steady_splits

#: Files of a batch; their paths and header lines are on the driver.
MAX_FILES = 100

#: Lines that a row may have, by breaks in its quoted cells.
ROW_LINES = 1_000
#: Bytes in which a header line has to end.
HEADER_BYTES = 1 << 20

FILE, RAW, REASON = "__file", "__raw", "__reason"
_LISTING = "path string, modificationTime timestamp, length long, content binary"


@dataclass(frozen=True)
class Ingested:
    batches: int  # merged by this run
    rejected: int  # rows kept back by this run


def read_csv_stream(
    spark: SparkSession,
    inbox: str,
    schema: T.StructType | None = None,
    archive: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """A stream of reading files of one known header, for scoring.

    ``schema`` lists the file's columns in order (default: the standard
    headers); sensor columns are parsed by the rules for readings, the others
    by their declared type.  A file with another header stops the stream
    instead of swapping columns; :func:`ingest` takes any header.  With
    ``archive``, the files of a committed batch are moved there when the next
    batch is planned.  ``max_files`` bounds a batch.
    """
    declared = schema or header_schema()
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in declared.fields])
    reader = (
        spark.readStream.schema(as_text).option("header", True).option("enforceSchema", False)
    )
    for name, value in _source_options(archive, max_files).items():
        reader = reader.option(name, value)
    return parse_text_columns(reader.csv(inbox), _types(declared))


def _source_options(archive: str | None, max_files: int | None) -> dict:
    options = {}
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    if max_files:
        options["maxFilesPerTrigger"] = max_files
    return options


def _types(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


# ---- files of a batch ---------------------------------------------------------


def header_lines(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The first line of each file that has one; no more of a file is read.

    A line beyond ``HEADER_BYTES`` is given as empty: no header is as long.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    found = {}
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        stream = target.getFileSystem(conf).open(target)
        try:
            codec = codecs.getCodec(target)
            lines = jvm.org.apache.hadoop.util.LineReader(stream if codec is None else codec.createInputStream(stream))
            line = jvm.org.apache.hadoop.io.Text()
            taken = lines.readLine(line, HEADER_BYTES, HEADER_BYTES)
            if taken:
                found[path] = line.toString() if taken < HEADER_BYTES else ""
        finally:
            stream.close()
    return found


def literal(path: str) -> str:
    """A path for Spark's readers, which take some characters of a name as a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _columns(header: str) -> list[str] | None:
    """Column names of a header line; None if they do not name each column once."""
    names = [n.strip() for n in next(csv.reader([header.removeprefix("﻿")]))]
    lowered = [HEADERS.get(n, n).lower() for n in names]
    return names if all(names) and len(set(lowered)) == len(names) else None


def _texts(spark: SparkSession, names: list[str], paths: list[str]) -> DataFrame:
    """Files of one header as text cells, with file, raw line and, for a malformed row, a reason."""
    found = splits(spark, [literal(p) for p in paths])
    # only where a line has an odd number of quotes a cell may go on in the next line
    odd = {same_file(spark, file) for file in {s.file for s in found if s.odd}}
    broken = [p for p in paths if same_file(spark, p) in odd]
    whole = [p for p in paths if p not in broken]
    if broken and whole:  # fewer files are split in another way
        found = splits(spark, [literal(p) for p in broken])
    schema = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(RAW, T.StringType())])
    parts = []
    if whole:
        rows = (
            spark.read.schema(schema)
            .options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=RAW, escape='"')
            .csv([literal(p) for p in whole])
        )
        parts.append(rows.withColumn(FILE, as_named(F.col("_metadata.file_name"))))
    if broken:
        parts.append(_joined_lines(spark, schema, broken, found))
    cells = F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]), {"escape": '"'})
    reason = F.when(F.col(RAW).isNotNull(), F.lit("wrong number of cells"))
    return reduce(DataFrame.unionByName, parts).withColumns({REASON: reason, RAW: F.coalesce(F.col(RAW), cells)})


# ---- quoted line breaks ---------------------------------------------------------


def _joined_lines(spark: SparkSession, schema: T.StructType, paths: list[str], found: list[Split]) -> DataFrame:
    """Rows of files in which quoted cells have line breaks; large files are read in splits all the same.

    Lines of a row are joined by a line feed.  What does not close within ``ROW_LINES``
    lines, or is no row of the header's width, is taken line by line.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW, "multiLine": "true", "escape": '"'}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)
    row = F.array_join("lines", "\n")
    is_row = (F.size("lines") == 1) | F.from_csv(row, ddl, options)[RAW].isNull()
    texts = rows_of_lines(spark, [literal(p) for p in paths], found, ROW_LINES).select(
        "file", F.explode(F.when(is_row, F.array(row)).otherwise(F.col("lines"))).alias("line")).where(F.trim("line") != "")
    cells = texts.withColumn("__row", F.from_csv("line", ddl, options))
    name = F.regexp_extract("file", "[^/]*$", 0)
    return cells.select(*[F.col(f"__row.`{f.name}`").alias(f.name) for f in schema.fields], name.alias(FILE))


def _unreadable_file(spark: SparkSession, header: str, paths: list[str]) -> DataFrame:
    lines = spark.read.text([literal(p) for p in paths]).where((F.trim("value") != "") & (F.col("value") != header))
    return lines.select(
        F.col("value").alias(RAW), as_named(F.col("_metadata.file_name")).alias(FILE),
        F.lit("the header does not name each column once").alias(REASON))


def _present(name: str) -> Column:
    text = F.trim(F.col(f"`{name}`"))
    return text.isNotNull() & ~text.isin(*MISSING_TEXTS)


def _judged(texts: DataFrame, types: dict[str, str], label: str | None) -> DataFrame:
    """Typed columns, with the reasons why a row cannot be used joined in one text."""
    to_name = {h: n for h, n in HEADERS.items() if h in texts.columns}
    named = texts.withColumnsRenamed(to_name)
    wanted = {HEADERS.get(n, n): kind for n, kind in types.items()}
    checked = [
        n for n in named.columns
        if n in FEATURES or n == TARGET or (n in wanted and wanted[n] != "string")
    ]
    held = named.withColumns({f"__given_{n}": _present(n) for n in checked})
    typed = parse_text_columns(held, wanted)
    reasons = [F.col(REASON)] + [
        F.when(F.col(f"__given_{n}") & F.col(f"`{n}`").isNull(), F.lit(f"unreadable {n}"))
        for n in checked
    ]
    if label:
        if label in typed.columns:
            value = F.col(f"`{label}`")
            reasons.append(F.when(value.isNull() & ~F.col(f"__given_{label}"), F.lit(f"no {label}")))
            reasons.append(F.when(~value.isin(0, 1), F.lit(f"{label} is not 0 or 1")))
        else:
            reasons.append(F.lit(f"no {label}"))
    whole = F.col(REASON).isNotNull()
    text = F.when(whole, F.col(REASON)).otherwise(F.concat_ws("; ", *reasons))
    return typed.withColumn(REASON, F.when(text != "", text)).drop(*[f"__given_{n}" for n in checked])


def read_files(
    spark: SparkSession, paths: list[str], schema: T.StructType | None = None, label: str | None = TARGET
) -> DataFrame:
    """Reading files with headers of their own as one table, columns taken by name.

    A column that a file lacks is NULL in its rows, and one that is not declared
    stays as text.  ``__reason`` is NULL for a usable row: one with as many cells
    as the header, readable numbers and, where ``label`` is given, a 0/1 class.
    ``__file`` and ``__raw`` say where a row is from and what it was.  Files
    without a line give no rows.
    """
    types = _types(schema or header_schema(label is not None))
    headers: dict[str, list[str]] = {}
    for path, line in header_lines(spark, paths).items():
        headers.setdefault(line, []).append(path)
    parts = []
    for line, files in sorted(headers.items()):
        names = _columns(line)
        parts.append(
            _unreadable_file(spark, line, files) if names is None
            else _judged(_texts(spark, names, files), types, label))
    if not parts:
        return spark.createDataFrame([], f"{FILE} string, {RAW} string, {REASON} string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# ---- files of committed batches ---------------------------------------------------


class Retired:
    """Moves the files of committed batches into an archive on the same file system.

    When a batch's rows are committed, a manifest of its files is written, and then the
    files move, to ``archive/<tag>/``.  A job that ends between two steps leaves the
    manifest, by which the next one goes on; what has moved is not looked for again.
    A manifest stays until a later batch comes, so a batch that Spark repeats because
    its own commit was lost is known to be done, though its files are gone.
    """

    def __init__(self, spark: SparkSession, folder: str, archive: str):
        self.spark, self.folder, self.archive = spark, folder, archive.rstrip("/")

    def _path(self, tag: str) -> str:
        return f"{self.folder}/{tag}.json"

    def _tags(self) -> list[str]:
        names = [p.rsplit("/", 1)[1] for p in children(self.spark, self.folder)]
        return sorted(n.removesuffix(".json") for n in names if n.endswith(".json") and not n.startswith("."))

    def is_done(self, tag: str) -> bool:
        return tag in self._tags()

    def done(self, tag: str, paths: list[str]) -> None:
        """Note that a batch is committed, and move its files."""
        put_if_absent(self.spark, self._path(tag), json.dumps(paths))
        self.move(tag)

    def move(self, tag: str) -> None:
        for path in json.loads(text_of(self.spark, self._path(tag))):
            system, source = located(self.spark, path)
            if not system.exists(source):
                continue
            _, folder = located(self.spark, f"{self.archive}/{tag}")
            system.mkdirs(folder)
            target = self.spark._jvm.org.apache.hadoop.fs.Path(folder, source.getName())
            if not system.rename(source, target):
                raise OSError(f"{path} could not be moved to {self.archive}")

    def finish(self, but: str | None = None) -> None:
        """Move what an earlier job has left; with ``but``, forget all batches before that one."""
        for tag in self._tags():
            self.move(tag)
            if but is not None and tag != but:
                discard(self.spark, self._path(tag))


# ---- the job --------------------------------------------------------------------


def ingest(
    store: DatasetStore,
    inbox: str,
    schema: T.StructType | None = None,
    archive: str | None = None,
    checkpoint: str | None = None,
    max_files: int | None = MAX_FILES,
    label: str | None = TARGET,
) -> Ingested:
    """Merge all files that are waiting, and keep back the rows that cannot be used.

    The checkpoint (default: next to the store) remembers the files, so each is
    merged once.  Duplicates are resolved against the stored rows rather than in
    stream state, which without an event time could never be dropped.  Rejected
    rows are below the store in ``rejects`` with file, raw text and reason.  With
    ``archive`` a batch's files move there as soon as it is committed.
    """
    checkpoint = checkpoint or f"{store.root}/ingest_checkpoint"
    source = hashlib.sha256(f"{checkpoint}|{inbox}".encode()).hexdigest()[:12]
    merged, kept_back = [], []

    retired = Retired(store.spark, f"{checkpoint}-retired", archive) if archive else None
    if retired:
        retired.finish()

    def merge(batch: DataFrame, batch_id: int) -> None:
        tag = f"{source}-{batch_id}"
        if retired:
            retired.finish(but=tag)
            if retired.is_done(tag):
                return
        paths = sorted(r.path for r in batch.select("path").collect())
        with scratch_tables(store.spark) as tables:
            # read several times below; in the shared folder it outlives executors
            with steady_splits(store.spark):
                read = read_files(store.spark, paths, schema, label)
                raw = F.when(F.col(REASON).isNotNull(), F.col(RAW))  # that of usable rows is not asked for
                rows = tables.write(read.withColumn(RAW, raw), "batch")
            rejected = store.reject(rows.where(F.col(REASON).isNotNull()).select(
                F.col(FILE).alias("file"), F.col(RAW).alias("raw"), F.col(REASON).alias("reason")), tag)
            usable = rows.where(F.col(REASON).isNull()).drop(FILE, RAW, REASON)
            if not usable.isEmpty():
                store.merge(usable, tag)
                merged.append(batch_id)
            kept_back.append(rejected)
        if retired:
            retired.done(tag, paths)

    reader = store.spark.readStream.format("binaryFile").schema(_LISTING)
    for name, value in _source_options(None, max_files).items():
        reader = reader.option(name, value)
    query = (
        reader.load(inbox).select("path")  # the contents are never loaded here
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return Ingested(len(merged), sum(kept_back))


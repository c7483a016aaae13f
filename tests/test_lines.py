"""Rows put together from the lines of files, against a plain reading of each file."""

import random

import pytest

from millwright.sources.scratch import Scratch
from millwright.sources.store import DatasetStore
from millwright.streaming.ingest import Ingested, ingest, read_files
from millwright.streaming.lines import rows_of_lines, splits, steady_splits
from tests.test_storage import NOTED, line, put


def plain(lines, most):
    """The rows of a file's lines without the first, as tuples of lines."""
    rows, inside = [], False
    for at, text in enumerate(lines):
        if not inside:
            rows.append([])
        if at:
            rows[-1].append(text)
        inside ^= text.count('"') % 2 == 1
    return [r for row in rows if row for r in ([tuple(row)] if len(row) <= most else [(x,) for x in row])]


@pytest.mark.parametrize("split_bytes", [60, 500, 128 << 20])
@pytest.mark.parametrize("most", [3, 1_000])
def test_rows_are_those_of_a_plain_reading(spark, folder, split_bytes, most):
    """Rows in one split, over several and over whole splits, quotes that do not close, and a header with one."""
    draw = random.Random(split_bytes + most)
    texts = {}
    for name in "abcde":
        header = 'x,"y' if name == "e" else "x,y"
        share = 0.02 if name == "d" else 0.3
        texts[name] = [header, *(draw.choice(["", "a", "bc,d" * 5, 'e""f']) + '"' * (draw.random() < share) for _ in range(150))]
        put(f"{folder}/inbox", f"{name}.csv", *texts[name][1:], header=header)
    paths = [f"{folder}/inbox/{name}.csv" for name in texts]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        with steady_splits(spark):
            found = splits(spark, paths)
            rows = rows_of_lines(spark, paths, found, most).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(found) > 50 or split_bytes > 60
    for name, lines in texts.items():
        mine = sorted(tuple(r.lines) for r in rows if r.file.endswith(f"/{name}.csv"))
        assert mine == sorted(plain(lines, most)), name


def test_lines_are_not_shuffled(spark, folder):
    put(f"{folder}/inbox", "a.csv", *[f'"n\n{n}",{line(float(n), n % 2)}' for n in range(20)], header=NOTED)
    rows = read_files(spark, [f"{folder}/inbox/a.csv"])
    assert "Window" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.engine_rpm for r in rows.collect()) == [float(n) for n in range(20)]


def test_a_batch_keeps_the_text_of_unusable_rows_only(spark, folder, monkeypatch):
    held = []

    def write(self, df, name, plain=Scratch.write):
        rows = plain(self, df, name)
        held.extend(r.asDict() for r in rows.collect() if name == "batch")
        return rows

    monkeypatch.setattr(Scratch, "write", write)
    put(f"{folder}/inbox", "a.csv", line(1.0), line(2.0, 1), "fast" + line(3.0))
    store = DatasetStore(spark, f"{folder}/store")
    assert ingest(store, f"{folder}/inbox") == Ingested(1, 1)
    assert sorted((r["__reason"] is None, r["__raw"] is None) for r in held) == [(False, False), (True, True), (True, True)]
    assert store.rejects().first().raw.startswith("fast3.0,")

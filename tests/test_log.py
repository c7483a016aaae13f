from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import types as T

from millwright.sources import log as logs
from millwright.sources.log import Conflict, VersionLog
from millwright.sources.store import DatasetStore
from tests.test_storage import bag, table

SCHEMA = T.StructType([
    T.StructField("version", T.LongType()), T.StructField("tag", T.StringType()),
    T.StructField("many", T.ArrayType(T.StringType())),
])


def names(folder):
    return sorted(p.name for p in Path(folder).iterdir() if not p.name.startswith("."))


def test_a_version_is_committed_once(spark, folder):
    log = VersionLog(spark, f"{folder}/log", SCHEMA)
    assert log.last() is None and log.rows().isEmpty()
    log.commit({"version": 0, "tag": "a", "many": ["é", 'x"y']})
    with pytest.raises(Conflict):
        VersionLog(spark, f"{folder}/log", SCHEMA).commit({"version": 0, "tag": "b"})
    log.commit({"version": 1, "tag": None})
    assert log.last() == {"version": 1, "tag": None, "many": None}
    assert [tuple(r) for r in log.rows().orderBy("version").collect()] == [(0, "a", ["é", 'x"y']), (1, None, None)]
    assert len(names(log.path)) == 2
    assert len(list(Path(log.path).iterdir())) == 2  # the loser's draft is gone


def test_what_is_read_stays_bounded(spark, folder, monkeypatch):
    monkeypatch.setattr(logs, "SNAPSHOT_EVERY", 5)
    log = VersionLog(spark, f"{folder}/log", SCHEMA, ("version", "tag"))
    for n in range(43):
        log.commit({"version": n, "tag": f"t{n}", "many": [str(n)]})
        assert len(names(log.path)) <= 2 * 5 + 2
        assert log.last()["tag"] == f"t{n}"
    rows = {r.version: r for r in log.rows().collect()}
    assert sorted(rows) == list(range(43)) and all(r.tag == f"t{v}" for v, r in rows.items())
    assert rows[42].many == ["42"] and rows[37].many == ["37"] and rows[3].many is None
    with pytest.raises(Conflict):
        log.commit({"version": 12, "tag": "late"})
    for path in Path(log.path).glob("*.json"):
        path.unlink()
    assert log.last() == {"version": 39, "tag": "t39", "many": ["39"]}


def test_of_many_writers_one_gets_each_version(spark, folder):
    log = VersionLog(spark, f"{folder}/log", SCHEMA)

    def writer(name):
        won = 0
        for n in range(12):
            try:
                log.commit({"version": n, "tag": f"{name}-{n}"})
                won += 1
            except Conflict:
                pass
        return won

    with ThreadPoolExecutor(4) as pool:
        won = list(pool.map(writer, "abcd"))
    assert sorted(r.version for r in log.rows().collect()) == list(range(12)) and sum(won) == 12


def test_a_rename_does_not_overwrite(spark, folder):
    """What other file systems than local ones are asked for."""
    for name in ("a", "b"):
        logs._write_text(spark, f"{folder}/x/.{name}", name)
    assert logs._renamed(spark, f"{folder}/x/.a", f"{folder}/x/0.json")
    assert not logs._renamed(spark, f"{folder}/x/.b", f"{folder}/x/0.json")
    assert logs.text_of(spark, f"{folder}/x/0.json") == "a" and names(f"{folder}/x") == ["0.json"]


def test_two_writers_lose_no_version_and_store_no_row_twice(spark, folder, monkeypatch):
    """Each commits while the other is about to."""
    one, two = DatasetStore(spark, f"{folder}/store"), DatasetStore(spark, f"{folder}/store")
    plain, overtaken = one.log.commit, []

    def late(row):
        if len(overtaken) < 3:
            overtaken.append(row["version"])
            two.merge(table(spark, [7, 100 + len(overtaken)]), f"other-{len(overtaken)}")
        plain(row)

    monkeypatch.setattr(one.log, "commit", late)
    one.merge(table(spark, [1, 7]), "first")
    assert overtaken == [0, 1, 2]
    one.merge(table(spark, [1, 2, 103]), "second")
    assert bag(one.read()) == bag(table(spark, [1, 2, 7, 101, 102, 103]))
    tags = [r.tag for r in one.versions().orderBy("version").collect()]
    assert tags == ["other-1", "other-2", "other-3", "first", "second"]
    used = set(one.current().segments)
    assert {p.name for p in Path(f"{folder}/store/rows").iterdir()} == used  # the overtaken took their rows away
    assert {p.name for p in Path(f"{folder}/store/filters").iterdir()} == used


def test_splits_and_models_of_two_writers_get_versions_of_their_own(spark, folder, monkeypatch):
    store, other = DatasetStore(spark, f"{folder}/store"), DatasetStore(spark, f"{folder}/store")
    plain, once = store.split_log.commit, []

    def late(row):
        if not once:
            once.append(other.publish_split(table(spark, [5]).selectExpr("*", "'test' split")))
        plain(row)

    monkeypatch.setattr(store.split_log, "commit", late)
    assert store.publish_split(table(spark, [6]).selectExpr("*", "'train' split")) == 1 and once == [0]
    assert store.read_split(version=0).first().engine_rpm == 5.0 and store.read_split().first().engine_rpm == 6.0


def test_vacuum_spares_what_is_being_written(spark, folder):
    store = DatasetStore(spark, f"{folder}/store")
    store.create(table(spark, [1]), dedupe=True)
    ahead = f"{store.root}/rows/00000001-other-1234"
    table(spark, [9]).write.parquet(ahead)
    table(spark, [9]).write.parquet(f"{store.root}/rows/00000000-lost-1234")
    assert store.vacuum() == 1 and Path(ahead).exists()

import gzip
from collections import Counter
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import types as T

from millwright.operators.evaluation import Flags
from millwright.operators.merging import distinct_batch
from millwright.plans.preparation import prepare
from millwright.schema import FEATURES, SENSORS, TARGET
from millwright.sources import readings as files
from millwright.sources.scratch import scratch_tables
from millwright.sources.store import DatasetStore
from millwright.streaming.ingest import HEADER_BYTES, Ingested, Retired, header_lines, ingest, read_csv_stream

HEADER = ",".join([s.header for s in SENSORS] + ["Engine Condition"])


def put(folder, name, *lines, header=HEADER):
    import os

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join([header, *lines]) + "\n")
    return f"{folder}/{name}"


def line(rpm, label=0):
    return f"{rpm},3.3,6.7,2.3,77.6,78.4,{label}"


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def table(spark, rpms):
    schema = ", ".join(f"{f} double" for f in FEATURES) + f", {TARGET} int"
    return spark.createDataFrame([(float(r), 3.3, 6.7, 2.3, 77.6, 78.4, int(r) % 2) for r in rpms], schema)


def test_csv_by_name_with_gaps(spark, folder):
    path = put(f"{folder}/in", "a.csv", "1,NA,700.0,-0.0,NaN,77.6,oops,x", " 0 ,,None,1,2,3,4,y",
               header="Engine Condition,Lub oil pressure,Engine rpm,Fuel pressure,Coolant pressure,"
                      "lub oil temp,Coolant temp,unit")
    df = files.read_csv(spark, path)
    first, second = df.orderBy("unit").collect()
    assert first.engine_rpm == 700.0 and first.engine_condition == 1
    assert first.lub_oil_pressure is None and first.coolant_pressure is None and first.coolant_temp is None
    assert str(first.fuel_pressure) == "0.0"
    assert second.engine_rpm is None and second.engine_condition == 0 and second.unit == "y"
    assert dict(df.dtypes)["engine_rpm"] == "double" and dict(df.dtypes)[TARGET] == "int"


def test_reordered_header_in_one_folder_fails(spark, folder):
    put(f"{folder}/in", "a.csv", line(1))
    other = ",".join(reversed(HEADER.split(",")))
    put(f"{folder}/in", "b.csv", "0,78.4,77.6,2.3,6.7,3.3,2", header=other)
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, f"{folder}/in").collect()


def test_split_csv_round_trip(spark, folder):
    df = table(spark, range(10)).selectExpr("*", "if(engine_rpm < 8, 'train', 'test') split")
    files.write_split_csv(df, f"{folder}/s")
    train, test = files.read_presplit_csv(spark, f"{folder}/s")
    assert (train.count(), test.count()) == (8, 2)
    assert bag(files.read_full_csv(spark, f"{folder}/s")) == bag(df.drop("split"))


def test_ingest_merges_each_file_once(spark, folder):
    store, inbox = DatasetStore(spark, f"{folder}/store"), f"{folder}/inbox"
    store.create(table(spark, [1, 1, 2]))
    assert not store.current().is_distinct
    put(inbox, "a.csv", line("2", 0), line("3", 1), line("3", 1))
    assert ingest(store, inbox) == Ingested(1, 0)
    assert bag(store.read()) == bag(table(spark, [1, 2, 3]))
    assert ingest(store, inbox) == Ingested(0, 0)
    put(inbox, "b.csv", line("3", 1), line("4", 0))
    assert ingest(store, inbox) == Ingested(1, 0)
    current = store.current()
    assert len(current.segments) == 2 and current.number == 2
    assert bag(store.read()) == bag(table(spark, [1, 2, 3, 4]))
    last = spark.read.parquet(f"{store.root}/rows/{current.segments[-1]}")
    assert bag(last) == bag(table(spark, [4]))  # only the new row was written


def test_merging_a_tag_again_changes_nothing(spark, folder):
    store = DatasetStore(spark, f"{folder}/store")
    store.create(table(spark, [1]), dedupe=True)
    first = store.merge(table(spark, [2]), "t-0")
    assert store.merge(table(spark, [2]), "t-0").number == first.number
    wider = table(spark, [1, 5]).selectExpr("*", "'u1' unit")
    store.merge(wider, "t-1")
    assert store.read().count() == 4 and store.read().where("unit is null").count() == 2


def segment_files(store):
    return {s: sorted(Path(f"{store.root}/rows/{s}").glob("*.parquet")) for s in store.current().segments}


def test_small_segments_are_compacted_and_large_ones_are_not(spark, folder, monkeypatch):
    monkeypatch.setattr("millwright.sources.store.TIER_SEGMENTS", 3)
    monkeypatch.setattr("millwright.sources.store.TIER_BYTES", 6_000)
    monkeypatch.setattr(DatasetStore.compact, "__defaults__", (3,))
    store = DatasetStore(spark, f"{folder}/store")
    store.create(table(spark, range(10_000)), dedupe=True)
    large = segment_files(store)
    for n in range(10_001, 10_006):
        store.merge(table(spark, [1, n]), f"t-{n}")
    now = segment_files(store)
    assert len(now) <= 3 and large.items() <= now.items()  # the large one is still the same files
    assert bag(store.read()) == bag(table(spark, [*range(10_000), *range(10_001, 10_006)]))
    assert store.versions().where("kind = 'compact'").count() >= 1


def test_vacuum_deletes_what_only_old_versions_use(spark, folder):
    store = DatasetStore(spark, f"{folder}/store")
    for n in range(4):
        store.create(table(spark, range(n + 1)), tag=f"c{n}")
        store.publish_split(table(spark, range(n + 1)).selectExpr("*", "'train' split"))
    old = store.versions().where("version = 2").first()
    assert store.vacuum(keep_versions=2, keep_splits=1) == 2 + 3
    assert store.read().count() == 4 and store.read_split().count() == 4
    assert spark.read.parquet(f"{store.root}/rows/{old.segments[0]}").count() == 3
    assert len(list(Path(f"{store.root}/splits").iterdir())) == 1
    assert store.vacuum() == 0
    with pytest.raises(ValueError):
        store.vacuum(0)


def test_a_batch_of_known_rows_adds_no_segment(spark, folder):
    store = DatasetStore(spark, f"{folder}/store")
    store.create(table(spark, [1, 2]), dedupe=True)
    version = store.merge(table(spark, [2, 1, 1]), "t-0")
    assert version.number == 1 and len(version.segments) == 1 and store.has_merged("t-0")
    assert len(list(Path(f"{store.root}/rows").iterdir())) == 1


# ---- filters of segments ------------------------------------------------------


def held(store, rows):
    """Segments and files that a merge of ``rows`` would read."""
    with scratch_tables(store.spark) as tables:
        written = tables.write(distinct_batch(store.read(), rows), "rows")
        return [p.removeprefix(f"{store.root}/rows/").split("/") for p in store.holding(store.current(), written, tables).paths]


def test_a_merge_reads_only_what_may_hold_its_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(DatasetStore.compact, "__defaults__", (100,))
    store = DatasetStore(spark, f"{folder}/store")
    for n in range(8):
        store.merge(table(spark, range(1_000 * n, 1_000 * n + 500)), f"t-{n}")
    assert len(store.current().segments) == 8
    batch = table(spark, [3_007, 3_007, *range(20_000, 20_300)])
    assert {segment for segment, *_ in held(store, batch)} == {store.current().segments[3]}
    assert held(store, table(spark, [-5])) == []
    store.merge(batch, "t-8")
    assert store.read().count() == 8 * 500 + 300
    assert bag(store.read()) == bag(table(spark, [*(x for n in range(8) for x in range(1_000 * n, 1_000 * n + 500)), *range(20_000, 20_300)]))


def test_of_a_segment_only_files_that_may_hold_a_row_are_read(spark, folder):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store = DatasetStore(spark, f"{folder}/store")
        store.create(table(spark, range(30_000)), dedupe=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (segment, files), = segment_files(store).items()
    assert len(files) > 1
    (found,) = held(store, table(spark, [17]))
    assert found[0] == segment
    assert spark.read.parquet(f"{store.root}/rows/{'/'.join(found)}").where("engine_rpm = 17").count() == 1
    monkey = store.merge(table(spark, [17, 29_999, 30_000]), "t-0")
    assert len(monkey.segments) == 2 and store.read().count() == 30_001


def test_many_hit_files_are_read_as_their_segment(spark, folder, monkeypatch):
    monkeypatch.setattr("millwright.sources.store.LISTED_FILES", 0)
    store = DatasetStore(spark, f"{folder}/store")
    store.create(table(spark, [1, 2]), dedupe=True)
    assert held(store, table(spark, [2])) == [list(store.current().segments)]
    assert store.merge(table(spark, [2]), "t-0").segments == store.current().segments


def test_filters_know_rows_across_schemas(spark, folder):
    """Absent columns are NULL; a column of another kind is not asked about but read."""
    store = DatasetStore(spark, f"{folder}/store")
    store.create(spark.createDataFrame([(0.0, 1), (None, 2), (float("nan"), 3)], "x double, y int"), dedupe=True)
    same = spark.createDataFrame([(3, float("nan"), None), (1, -0.0, None), (2, None, None), (2, None, "u")], "Y bigint, X double, unit string")
    assert len(held(store, same)) == 1
    store.merge(same, "t-0")
    assert store.read().count() == 4 and store.read().where("unit = 'u'").count() == 1
    other = DatasetStore(spark, f"{folder}/other")
    other.create(spark.createDataFrame([(5,), (6,)], "x int"), dedupe=True)
    as_double = spark.createDataFrame([(5.0,), (7.5,)], "x double")
    assert held(other, as_double) == [list(other.current().segments)]


def test_a_store_without_filters_is_read_whole(spark, folder):
    store = DatasetStore(spark, f"{folder}/store")
    store.create(table(spark, [1, 2]), dedupe=True)
    current = store.current()
    bare = replace(current, filters=())
    monkey = store.current
    store.current = lambda: bare
    try:
        assert held(store, table(spark, [9])) == [list(current.segments)]
        assert store.merge(table(spark, [2, 9]), "t-0").number == 1
    finally:
        store.current = monkey
    assert store.read().count() == 3 and len(store.current().filters) == 1


# ---- headers and bad rows ---------------------------------------------------


def test_files_are_taken_by_name(spark, folder):
    store, inbox = DatasetStore(spark, f"{folder}/store"), f"{folder}/inbox"
    put(inbox, "a.csv", line(1.0, 1))
    put(inbox, "b.csv", "0,78.4,77.6,2.3,6.7,3.3,2", header=",".join(reversed(HEADER.split(","))))
    put(inbox, "c.csv", "u7," + line(3.0, 1), header="Unit," + HEADER)
    put(inbox, "d.csv", line(4.0, 0), header="\ufeff" + HEADER)
    put(inbox, "e.csv", "5.0,1", header="Engine rpm,Engine Condition")
    Path(f"{inbox}/empty.csv").touch()
    assert ingest(store, inbox) == Ingested(1, 0)
    rows = {r.engine_rpm: r for r in store.read().collect()}
    assert sorted(rows) == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert rows[2.0].coolant_temp == 78.4 and rows[3.0].Unit == "u7" and rows[1.0].Unit is None
    assert rows[5.0].fuel_pressure is None and rows[5.0].engine_condition == 1
    lines = header_lines(spark, [f"{inbox}/a.csv", f"{inbox}/empty.csv"])
    assert list(lines.values()) == [HEADER]


def test_any_file_name_is_read(spark, folder):
    names = ["a[1].csv", "b{1}.csv", "c{1.csv", "d].csv", "e*.csv", "f?.csv", "g\\h.csv", "i j.csv", "k%20l.csv", "m[!a].csv", "good.csv"]
    store, inbox = DatasetStore(spark, f"{folder}/store"), f"{folder}/inbox"
    for n, name in enumerate(names):
        put(inbox, name, line(float(n), n % 2))
    put(inbox, "bad[x].csv", "1,2", header="Engine rpm,engine_rpm")
    assert ingest(store, inbox) == Ingested(1, 1)
    assert bag(store.read()) == bag(table(spark, range(len(names))))
    assert store.rejects().first().file == "bad[x].csv"


def test_header_lines_are_read_and_no_more(spark, folder):
    put(folder, "long.csv", header="x" * (HEADER_BYTES + 1))
    put(folder, "plain.csv", line(1), header="a,b")
    with gzip.open(f"{folder}/packed.csv.gz", "wt") as out:
        out.write("c,d\r\n1,2\r\n")
    Path(f"{folder}/none.csv").touch()
    paths = [f"{folder}/{n}" for n in ("long.csv", "plain.csv", "packed.csv.gz", "none.csv")]
    assert list(header_lines(spark, paths).values()) == ["", "a,b", "c,d"]


def test_bad_rows_are_kept_back_with_their_reason(spark, folder):
    store, inbox = DatasetStore(spark, f"{folder}/store"), f"{folder}/inbox"
    put(inbox, "a.csv", line(1.0, 1), line("fast", 0), line(3.0, "x"), line(4.0, ""), line(5.0, 2),
        "6.0,3.3", line("NA", 0), line(8.0, 1) + ",9", line("slow", "y"))
    put(inbox, "b.csv", "1,2", header="Engine rpm,engine_rpm")
    assert ingest(store, inbox) == Ingested(1, 8)
    assert sorted((r.engine_rpm or 0.0) for r in store.read().collect()) == [0.0, 1.0]
    rejects = {r.raw: (r.file, r.reason) for r in store.rejects().collect()}
    assert rejects[line("fast", 0)] == ("a.csv", "unreadable engine_rpm")
    assert rejects[line(3.0, "x")][1] == "unreadable engine_condition"
    assert rejects[line(5.0, 2)][1] == "engine_condition is not 0 or 1"
    assert rejects["6.0,3.3"][1] == rejects[line(8.0, 1) + ",9"][1] == "wrong number of cells"
    assert rejects[line("slow", "y")][1] == "unreadable engine_rpm; unreadable engine_condition"
    assert rejects["1,2"] == ("b.csv", "the header does not name each column once")
    assert sum(reason == "no engine_condition" for _, reason in rejects.values()) == 1


def test_a_bad_file_does_not_stop_later_ones(spark, folder):
    store, inbox = DatasetStore(spark, f"{folder}/store"), f"{folder}/inbox"
    store.create(table(spark, range(20)))
    put(inbox, "bad.csv", line(50.0, "broken"), line("", ""))
    bad = prepare(store, "merge", inbox)
    assert (bad.merged, bad.published, bad.rejected) == (False, None, 2)
    put(inbox, "good.csv", line(51.0, 1), line(52.0, 0))
    good = prepare(store, "merge", inbox)
    assert (good.merged, good.published, good.rejected) == (True, 0, 0)
    assert good.rows.count() == 22 and store.rejects().count() == 2


def test_rows_without_a_class_are_in_no_split(spark, folder):
    store = DatasetStore(spark, f"{folder}/store")
    store.create(table(spark, range(20)).selectExpr("* except (engine_condition)", "if(engine_rpm > 0, engine_condition, null) engine_condition"))
    done = prepare(store, "resplit")
    assert done.unclassed == 1 and done.rows.count() == 19


def test_an_interrupted_merge_is_published_by_the_next_run(spark, folder):
    store, inbox = DatasetStore(spark, f"{folder}/store"), f"{folder}/inbox"
    store.create(table(spark, range(20)))
    put(inbox, "a.csv", line(30.0, 0), line(31.0, 1))
    ingest(store, inbox)  # and the job dies before it publishes
    again = prepare(store, "merge", inbox)
    assert again.merged and again.published == 0 and again.rows.count() == 22
    assert store.published_data_version() == store.current().number
    idle = prepare(store, "merge", inbox)
    assert not idle.merged and idle.published is None


def test_stream_stops_on_another_header(spark, folder):
    put(f"{folder}/in", "a.csv", line(1), header=",".join(reversed(HEADER.split(","))))
    query = (read_csv_stream(spark, f"{folder}/in").writeStream.format("noop")
             .option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start())
    with pytest.raises(Exception):
        query.awaitTermination()


def test_prepare_modes(spark, folder):
    store, inbox = DatasetStore(spark, f"{folder}/store"), f"{folder}/inbox"
    with pytest.raises(LookupError):
        prepare(store, "presplit")
    store.create(table(spark, range(20)))
    put(inbox, ".keep")
    plain = prepare(store, "resplit")
    assert plain.published is None and plain.rows.where("split = 'test'").count() == 4
    nothing = prepare(store, "merge", inbox)
    assert not nothing.merged and nothing.published is None
    put(inbox, "a.csv", *[line(float(r), r % 2) for r in range(15, 30)])
    merged = prepare(store, "merge", inbox)
    assert merged.merged and merged.published == 0
    assert merged.rows.where("split = 'train'").count() == 24
    assert bag(prepare(store, "presplit").rows) == bag(merged.rows)
    pruned = store.read_split("test")
    assert "PartitionFilters: [isnotnull(split" in pruned._jdf.queryExecution().executedPlan().toString()
    assert Flags(data_updated=merged.merged).forces


def test_typed_extra_columns(spark, folder):
    path = put(f"{folder}/in", "a.csv", "9007199254740993," + line(1), header="id," + HEADER)
    schema = T.StructType([T.StructField("id", T.LongType()),
                           *[T.StructField(h, T.StringType()) for h in HEADER.split(",")]])
    assert files.read_csv(spark, path, {"id": "bigint"}).first().id == 9007199254740993
    assert dict(read_csv_stream(spark, f"{folder}/in", schema).dtypes)["id"] == "bigint"


def test_bounded_batches_and_archive(spark, folder):
    store, inbox = DatasetStore(spark, f"{folder}/store"), f"{folder}/inbox"
    for n in range(3):
        put(inbox, f"{n}.csv", line(float(n), n % 2))
    done = ingest(store, inbox, archive=f"{folder}/done", max_files=1)
    assert done.batches == 3 and bag(store.read()) == bag(table(spark, [0, 1, 2]))
    assert len(store.current().segments) == 3


def archived_names(folder):
    return sorted(p.name for p in Path(f"{folder}/done").rglob("*.csv"))


def test_files_move_as_soon_as_they_are_merged(spark, folder):
    store, inbox = DatasetStore(spark, f"{folder}/store"), f"{folder}/inbox"
    for n, name in enumerate(["a.csv", "b[1].csv", "c%20d.csv"]):
        put(inbox, name, line(float(n), n % 2))
    put(inbox, "bad.csv", line("x", "y"))
    done = ingest(store, inbox, archive=f"{folder}/done", max_files=2)
    assert done == Ingested(2, 1) and list(Path(inbox).glob("*.csv")) == []
    assert archived_names(folder) == ["a.csv", "b[1].csv", "bad.csv", "c%20d.csv"]
    assert len(list(Path(f"{store.root}/ingest_checkpoint-retired").glob("*.json"))) == 1
    put(inbox, "e.csv", line(9.0, 1))
    assert ingest(store, inbox, archive=f"{folder}/done") == Ingested(1, 0)
    assert bag(store.read()) == bag(table(spark, [0, 1, 2, 9])) and len(archived_names(folder)) == 5


@pytest.mark.parametrize("step", ["done", "move"])
@pytest.mark.parametrize("label", [1, "bad"])
def test_a_job_that_ends_before_its_files_have_moved(spark, folder, monkeypatch, step, label):
    """It is gone on with: no row is lost or merged twice, and every file moves."""
    store, inbox = DatasetStore(spark, f"{folder}/store"), f"{folder}/inbox"
    store.create(table(spark, [1]), dedupe=True)
    for name in "ab":
        put(inbox, f"{name}.csv", line(5.0, label))

    def stop(*_):
        raise RuntimeError("the job ends here")

    with monkeypatch.context() as patch:
        patch.setattr(Retired, step, stop)
        with pytest.raises(Exception, match="the job ends here"):
            ingest(store, inbox, archive=f"{folder}/done")
    assert archived_names(folder) == []
    ingest(store, inbox, archive=f"{folder}/done")
    assert archived_names(folder) == ["a.csv", "b.csv"]
    assert bag(store.read()) == bag(table(spark, [1, 5] if label == 1 else [1]))
    assert store.rejects().count() == (0 if label == 1 else 2)
    assert ingest(store, inbox, archive=f"{folder}/done") == Ingested(0, 0)


NOTED = "Note," + HEADER


@pytest.mark.parametrize("split_bytes", [128 << 20, 200])
def test_quoted_cells_may_have_line_breaks(spark, folder, monkeypatch, split_bytes):
    """In one split and over many, beside files without breaks and with quotes that do not close."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        store, inbox = DatasetStore(spark, f"{folder}/store"), f"{folder}/inbox"
        notes = [f'"n{n}\n' + "more, text\n\n" * (n % 40) + f'and ""quoted"" {n}"' for n in range(60)]
        put(inbox, "a.csv", *[f"{note},{line(float(n), n % 2)}" for n, note in enumerate(notes)], header=NOTED)
        put(inbox, "b.csv", *[f'"plain, {n}",{line(float(n), n % 2)}' for n in range(60, 80)], header=NOTED)
        put(inbox, "c[1].csv", f'5" wide,{line(80.0, 0)}', "", f'x,{line(81.0, 1)}', f'"open,{line(82.0, 0)}', header=NOTED)
        done = ingest(store, inbox)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    rows = {r.engine_rpm: r.Note for r in store.read().collect()}
    for n, note in enumerate(notes):
        assert rows[float(n)] == note[1:-1].replace('""', '"'), n
    assert [rows[float(n)] for n in range(60, 80)] == [f"plain, {n}" for n in range(60, 80)]
    assert rows[80.0] == '5" wide' and rows[81.0] == "x" and done.rejected == 1 and len(rows) == 82
    assert store.rejects().first().file == "c[1].csv"


def test_a_quote_that_never_closes_is_taken_line_by_line(spark, folder, monkeypatch):
    monkeypatch.setattr("millwright.streaming.ingest.ROW_LINES", 5)
    store, inbox = DatasetStore(spark, f"{folder}/store"), f"{folder}/inbox"
    put(inbox, "a.csv", f'"a\nb",{line(1.0, 1)}', f'"never,{line(2.0, 1)}', *[f"x,{line(float(n), 0)}" for n in range(3, 13)], header=NOTED)
    assert ingest(store, inbox) == Ingested(1, 1)
    assert sorted(r.engine_rpm for r in store.read().collect()) == [1.0, *map(float, range(3, 13))]

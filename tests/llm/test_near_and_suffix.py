"""Near dedup and passage removal against brute force."""

import random

import numpy as np
import pytest

from millwright.llm.components import components
from millwright.llm.near_dedup import (
    _joining, _linked, DEALT_FROM, dealt_sketch, estimated_jaccard, near_dedup, shingle_set, small_sketch, without_near_copies,
)
from millwright.llm.suffix_dedup import repeated_passages
from millwright.llm.suffix_sort import BlindTrie, sort_suffixes
from millwright.sources.scratch import Scratch
from tests.conftest import SF_DIR
from tests.llm import cases
from tests.llm.cases import clashing, docs, edge_rows, words


def edited(text, n, seed):
    pick, found = random.Random(seed), text.split()
    for _ in range(n):
        found[pick.randrange(len(found))] = f"new{pick.randrange(10**6)}"
    return " ".join(found)


def found_near(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup(df).collect()}


def found_passages(df, **options):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeated_passages(df, **options).collect()}


def test_near_of_the_documents(spark):
    rows = cases.documents(spark, SF_DIR)
    assert found_near(docs(spark, rows)) == cases.near(rows)


@pytest.mark.parametrize("length", [40, 300, 1100, 1400])
def test_near_copies_around_the_threshold(spark, length):
    original = words(length, length)
    edits = [max(1, round(length * share)) for share in (0.01, 0.02, 0.028, 0.03, 0.033, 0.04, 0.06)]
    rows = [(0, original)] + [(10 * i + j, edited(original, n, 100 * i + j)) for i, n in enumerate(edits, 1) for j in range(6)]
    rows += [(1000 + i, original.rsplit(" ", round(length * share))[0]) for i, share in enumerate((0.2, 0.24, 0.26, 0.3))]
    rows += [(2000 + i, words(length, 9_000 + i)) for i in range(20)]
    assert found_near(docs(spark, rows)) == cases.near(rows)


def test_a_large_group_whose_copies_are_far_from_each_other(spark):
    """Copies are linked with the original and hardly with each other; the original is no group's smallest id."""
    original = words(200, 5)
    rows = [(i, edited(original, 5, i)) for i in range(120)] + [(500, original)]
    assert found_near(docs(spark, rows)) == cases.near(rows)


def test_small_tables_are_written_in_few_files(spark, monkeypatch):
    """However many partitions a shuffle has; every file costs a task, and a local file system a process or more."""
    rows = [(10 * i + j, edited(words(300, i), j, 10 * i + j)) for i in range(60) for j in range(3)]
    files, write = {}, Scratch.write

    def counted(tables, df, name):
        done = write(tables, df, name)
        files[name] = max(files.get(name, 0), len(done.inputFiles()))
        return done

    monkeypatch.setattr(Scratch, "write", counted)
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        assert found_near(docs(spark, rows)) == cases.near(rows)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    few = {"near-classes", "near-members", "near-dealt", "stars", "near-labels"}
    assert few <= set(files)
    assert max(files[name] for name in few) <= 2 * spark.sparkContext.defaultParallelism


def test_joining_is_exact_at_the_threshold_of_very_long_documents():
    """671,097 shared of 894,796 shingles are 75 %; one less is not."""
    values = np.arange(894_796, dtype=np.uint64)
    for shared, found in ((671_097, [(1, 2)]), (671_096, [])):
        a, b = values[:shared], values
        assert _joining((0, 0, 0), [(1, 1, a.tobytes()), (2, 2, b.tobytes())]) == found
        assert _linked((a.tobytes(),), (b.tobytes(),)) == bool(found)


def test_near_edges(spark):
    table = clashing(docs(spark, edge_rows()))
    rows = near_dedup(table).collect()
    assert len(rows) == len(edge_rows())
    found = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (found[1].n_shingles, found[1].component_id, found[1].kept) == (0, 1, True)
    assert (found[2].component_id, found[3].component_id) == (2, 3)  # no words, no links
    assert (found[5].component_id, found[6].component_id, found[4].n_shingles) == (4, 4, 1)
    assert (found[8].component_id, found[11].component_id) == (7, 10)
    assert {(r.component_id, r.kept) for r in rows if r.doc_id is None} == {(None, True)}
    left = without_near_copies(table)
    assert left.columns == table.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == [1, 2, 3, 4, 7, 9, 10]
    assert near_dedup(docs(spark, [])).collect() == []


def test_rows_of_one_id_and_different_texts_are_documents_of_their_own(spark):
    original, unique, other = words(200, 5), words(200, 6), words(200, 7)
    rows = [(3, original), (5, unique), (5, edited(original, 2, 1)), (5, None), (5, ""), (7, other), (7, edited(other, 2, 2)),
            (8, edited(unique, 2, 3)), (9, words(200, 8), "b"), (9, words(200, 8), "a"), (9, words(200, 8), "c"), (None, unique)]
    left = without_near_copies(docs(spark, rows).repartition(7))
    found = sorted(((r.doc_id, r.text, r.source) for r in left.collect()), key=repr)
    seven = [x for x in found if x[0] == 7]
    assert len(seven) == 1 and seven[0][1] in (rows[5][1], rows[6][1])
    assert [x for x in found if x[0] != 7] == sorted([
        (3, original, "src0"), (5, unique, "src0"), (5, None, "src0"), (5, "", "src0"),
        (9, words(200, 8), "a"), (None, unique, "src0")], key=repr)
    again = without_near_copies(docs(spark, rows[::-1]).repartition(3))
    assert sorted(((r.doc_id, r.text, r.source) for r in again.collect()), key=repr) == found


def test_of_repeated_rows_one_stays_in_a_fixed_order(spark):
    rows = [(9, words(200, 8), s) for s in "dbac"] + [(10, words(200, 9), "x")]
    for table in (docs(spark, rows).coalesce(1), docs(spark, rows[::-1]).coalesce(1)):
        left = without_near_copies(table)
        assert left.columns == table.columns
        assert sorted((r.doc_id, r.source) for r in left.collect()) == [(9, "a"), (10, "x")]


def test_sketches_estimate_jaccard():
    for n, make, buckets in ((400, small_sketch, 1), (6_000, dealt_sketch, 128)):
        a, b = shingle_set(words(n, 1, 10**6).encode()), shingle_set(edited(words(n, 1, 10**6), n // 50, 3).encode())
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(estimated_jaccard(make(a), make(b), len(a), len(b), buckets) - true) < 0.15
        other = shingle_set(words(n, 2, 10**6).encode())
        assert estimated_jaccard(make(a), make(other), len(a), len(other), buckets) < 0.05
    assert DEALT_FROM > 4 * 128  # hardly a bucket stays empty


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 50)] + [(130, 60)]
    links = spark.createDataFrame(chain + star + [(7, 7), (None, 3), (3, 2)], "a long, b long")
    tables = Scratch(spark)
    found = dict(components(links, tables).collect())
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 60 for i in range(100, 150)}}
    assert components(links.limit(0), tables).collect() == []
    tables.clear()


def test_passages_of_the_documents(spark):
    rows = cases.documents(spark, SF_DIR)
    expected = cases.repeated(rows)
    assert found_passages(docs(spark, rows)) == expected
    assert sum(x[1] for x in expected.values()) > 10_000
    small = dict(slice_bytes=20_000, range_bytes=30_000, hot_slices=2)  # many slices and ranges, hot grams
    assert found_passages(docs(spark, rows), **small) == expected


def test_passages_of_periodic_and_shared_text(spark):
    shared = "The same passage of more than fifty bytes is in each of these documents, é included. "
    rows = [(i, f"{words(30, i)} {shared * (i % 3)}{words(20, 50 + i)}") for i in range(40)]
    rows += [(100, "ab" * 300), (101, "b" + "ab" * 200), (102, "x" * 49), (103, "x" * 50), (104, "x" * 400), (105, "x" * 49)]
    expected = cases.repeated(rows)
    assert found_passages(docs(spark, rows)) == expected
    assert found_passages(docs(spark, rows), slice_bytes=500, range_bytes=1_000, hot_slices=1) == expected


def test_passages_edges(spark):
    rows = repeated_passages(clashing(docs(spark, edge_rows()))).collect()
    assert len(rows) == len(edge_rows())
    found = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (found[1].n_bytes, found[1].n_removed, found[1].n_spans, found[2].n_bytes) == (0, 0, 0, 0)
    assert found[7].n_removed == 0 and found[8].n_removed == found[8].n_bytes and found[8].n_spans == 1
    assert found[9].n_bytes == 400 and found[9].n_removed == 0  # repeats within one document stay
    assert found[11].n_removed == found[11].n_bytes
    nameless = {r.n_bytes: r.n_removed for r in rows if r.doc_id is None}
    assert nameless == {3: 0, 0: 0}
    late = {r.doc_id: r.n_removed for r in repeated_passages(docs(spark, [(None, words(30, 1)), (5, words(30, 1))])).collect()}
    assert late[5] == 0 and late[None] > 0  # a row without an id comes last
    assert repeated_passages(docs(spark, [])).collect() == []
    assert [r.n_removed for r in repeated_passages(docs(spark, [(1, None), (2, "short")])).collect()] == [0, 0]


def test_spans_are_the_removed_bytes(spark):
    passage = words(20, 8)
    rows = [(1, passage), (2, f"before {passage} after {words(9, 4)} {passage}")]
    found = {r.doc_id: r for r in repeated_passages(docs(spark, rows)).collect()}
    raw = rows[1][1].encode()
    assert [raw[s.start : s.end].decode() for s in found[2].spans] == [passage] * 2


def test_suffixes_are_sorted():
    pick = np.random.default_rng(4)
    for symbols in (2, 4, 250):
        base = pick.integers(0, symbols, 300).astype(np.uint8)
        copies = [np.where(pick.random(300) < 0.01, 7, base).astype(np.uint8) for _ in range(12)]
        text = np.concatenate([base, *copies])
        at = pick.permutation(len(text) - 50)
        order, new = sort_suffixes(text, at, 50)
        strings = [text[a : a + 50].tobytes() for a in at[order]]
        assert strings == sorted(strings)
        assert new.tolist() == [i == 0 or strings[i] != strings[i - 1] for i in range(len(strings))]


def test_a_blind_trie_orders_and_groups():
    pick = random.Random(2)
    strings = [bytes(pick.choices(b"ab", k=8)) for _ in range(400)]
    trie = BlindTrie(8)
    for i, s in enumerate(strings):
        trie.insert(s, i)
    leaves = trie.leaves()
    assert [strings[leaf[0]] for leaf in leaves] == sorted(set(strings))
    assert all(len({strings[i] for i in leaf}) == 1 for leaf in leaves)

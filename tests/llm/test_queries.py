"""The registered queries against their SQL or brute force, and the pipeline's stages."""

from collections import Counter

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from check import compare, sql_connection
from millwright.llm.mixing import words_taken
from millwright.llm.oracles import ORACLES
from millwright.llm.queries import QUERIES, VOCABULARY
from millwright.llm.text import table
from tests.conftest import SF_DIR
from tests.llm import cases
from tests.llm.test_archives_urls_packing import check_places


@pytest.fixture(scope="module")
def con():
    return sql_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name).startswith("ok")


def test_all_queries_and_the_pipeline_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


def test_queries_without_sql(spark):
    rows = cases.documents(spark, SF_DIR)
    passages = {r.doc_id: tuple(r)[1:] for r in QUERIES["op4_suffix_dedup"](spark, SF_DIR).collect()}
    assert passages == cases.repeated(rows)
    near = {r.doc_id: tuple(r)[1:] for r in QUERIES["op5_near_dedup"](spark, SF_DIR).collect()}
    assert near == cases.near(rows)


def test_stages(spark):
    """Each stage on what the one before kept."""
    docs = table(spark, SF_DIR, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
    quality = [(r.doc_id, r.text) for r in seen["quality_rules"].collect()]
    assert all(len(t.split()) >= 50 for _, t in quality)
    lines = [(r.doc_id, r.text) for r in seen["line_dedup"].collect()]
    assert [d for d, _ in sorted(quality)] == [d for d, _ in sorted(lines)]
    assert all(r.n_chars == len(r.text) for r in seen["line_dedup"].collect())
    kept = {d for d, (_, _, stays) in cases.near(lines).items() if stays}
    assert sorted(r.doc_id for r in seen["near_dedup"].collect()) == sorted(kept)
    assert {r.doc_id for r in seen["mix_sources"].collect()} <= kept
    taken = {r.doc_id: r.taken for r in words_taken(seen["near_dedup"]).collect() if r.taken}
    mixed, tokens = Counter(), Counter()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    for r in seen["mix_sources"].collect():
        mixed[r.doc_id] += len(r.text.encode().split())
        tokens[r.doc_id] += len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1
    assert mixed == taken
    pieces = seen["packing"].collect()
    held = Counter()
    for r in pieces:
        held[r.doc_id] += r.length
    assert held == tokens
    n = check_places(pieces, 2048)
    assert n <= -(-sum(tokens.values()) // 2048) + 1


def test_the_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls, repeated rows and clashing columns go through every stage."""
    rows = cases.edge_rows() + [(20 + i, cases.words(80, i), None if i % 3 else "src2") for i in range(12)]
    cases.clashing(cases.docs(spark, rows)).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    cases.docs(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0

"""Every registered query against its SQL, on the smallest tables."""

import threading
from functools import wraps
from pathlib import Path

import pytest

import __spark_entry__ as contract
from check import compare, sql_connection
from workload import queries
from workload.oracles import ORACLES
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    return sql_connection(SF_DIR)


# the models of the full preset take minutes; check.py compares their queries
SLOW = {"train_gbt", "score_gbt", "evaluate_gbt", "train_newton", "score_newton", "evaluate_newton",
        "promote_model", "model_facts"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name).startswith("ok")


@pytest.fixture(scope="module")
def few_trees(tmp_path_factory):
    """The model queries with few trees, whose models are kept in a folder of the tests."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(queries, "N_TREES", 3)
        patch.setattr(queries.tempfile, "gettempdir", lambda: str(tmp_path_factory.getbasetemp() / "models"))
        yield


@pytest.mark.parametrize("name", sorted(SLOW - {"model_facts", "promote_model"}))
def test_model_queries_of_few_trees(spark, few_trees, name):
    assert compare(spark, None, SF_DIR, name).startswith("rows only")


@pytest.mark.parametrize("name", ["model_facts", "promote_model"])
def test_model_queries_match_sql(spark, few_trees, con, name, monkeypatch):
    monkeypatch.setattr(contract, "oracle_sql", lambda: {name: ORACLES[name].replace("cast(250 as", "cast(3 as")})
    assert compare(spark, con, SF_DIR, name).startswith("ok")


def test_only_training_queries_train_again(spark, few_trees, monkeypatch):
    first = queries.QUERIES["score_newton"](spark, SF_DIR).count()
    monkeypatch.setattr(queries.boosting, "train_newton", None)
    assert queries.QUERIES["score_newton"](spark, SF_DIR).count() == first
    with pytest.raises(TypeError):
        queries.QUERIES["train_newton"](spark, SF_DIR)


@pytest.fixture
def untrained(monkeypatch, folder):
    """The model queries with a tree each and no kept models."""
    monkeypatch.setattr(queries, "N_TREES", 1)
    monkeypatch.setattr(queries, "_trained", lambda spark, sf_dir, trainer: queries.ModelRegistry(
        spark, f"{folder}/{trainer.__name__}"))


@pytest.mark.parametrize("name", ["model_facts", "promote_model"])
def test_both_models_are_trained_at_the_same_time(spark, monkeypatch, untrained, name):
    both, n_rows = threading.Barrier(2), []

    def met(trainer):
        @wraps(trainer)
        def trained(train):
            both.wait(60)
            n_rows.append(train.count())
            return trainer(train)
        return trained

    for trainer in ("_gbt", "_newton"):
        monkeypatch.setattr(queries, trainer, met(getattr(queries, trainer)))
    assert queries.QUERIES[name](spark, SF_DIR).count() == 2
    assert len(n_rows) == 2 and n_rows[0] == n_rows[1] > 0


@pytest.mark.parametrize("name", ["model_facts", "promote_model"])
def test_kept_models_do_not_stand_in_for_training(spark, monkeypatch, untrained, name):
    trained = []

    def counted(trainer):
        @wraps(trainer)
        def counts(train):
            trained.append(trainer.__name__)
            return trainer(train)
        return counts

    for trainer in ("_gbt", "_newton"):
        queries.QUERIES[f"train{trainer}"](spark, SF_DIR).count()  # kept from now on
        monkeypatch.setattr(queries, trainer, counted(getattr(queries, trainer)))
    assert queries.QUERIES[name](spark, SF_DIR).count() == 2
    assert sorted(trained) == ["_gbt", "_newton"]


@pytest.mark.parametrize("name", ["score_gbt", "evaluate_gbt", "score_newton", "evaluate_newton"])
def test_a_model_and_the_rows_it_meets_come_of_one_split(spark, monkeypatch, untrained, name):
    splits, split = [], queries.fx.split_readings
    monkeypatch.setattr(queries.fx, "split_readings", lambda *a: splits.append(a) or split(*a))
    assert queries.QUERIES[name](spark, SF_DIR).count() > 0
    assert len(splits) == 1


def test_entry(spark):
    row = contract.entry(spark).first()
    assert 0.5 < row.roc_auc <= 1.0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert SLOW <= set(contract.queries())


def test_short_rows_are_written_by_as_many_tasks_as_there_are(spark, folder):
    rows = spark.range(0, 40, 1, 4).selectExpr(
        *[f"case when id % 7 = 0 then 'n/a' else cast(id + {i} as string) end as `{h}`" for i, h in enumerate(queries._HEADERS)])
    queries._write_short(rows, f"{folder}/in")
    files = [path.read_text().splitlines() for path in Path(f"{folder}/in").glob("part-*")]
    assert len(files) == 4 and {f[0] for f in files} == {",".join(queries._HEADERS)}
    assert sorted(line for f in files for line in f[1:]) == sorted(",".join(r[:-1]) for r in rows.collect())

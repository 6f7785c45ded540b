"""Each registered query against its SQL on the smallest tables."""

from dataclasses import replace

import duckdb
import pytest

import __spark_entry__ as entry
from cardflow.plans import training
from checks import queries as registered

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


# Their trees are few and flat here; the queries themselves run the defaults.
MODELS = ["gbt_train_score", "param_search"]


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(registered.queries()) - set(ORACLES) == {"fraud_train_score"}


def _equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    ours = sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    assert ours == sorted(repr(tuple(r)) for r in result.fetchall())


@pytest.mark.parametrize("name", sorted(set(ORACLES) - set(MODELS)))
def test_query_equals_sql(spark, duck, name):
    _equals_sql(spark, duck, name)


@pytest.fixture()
def few_trees(monkeypatch):
    fit = training._fit_trees
    small = lambda rows, params, seed: fit(rows, replace(params, trees=2, max_depth=min(params.max_depth, 4)), seed)
    monkeypatch.setattr(training, "_fit_trees", small)


@pytest.mark.parametrize("name", MODELS)
def test_model_query_equals_sql(spark, duck, name, few_trees):
    _equals_sql(spark, duck, name)


def test_trees_on_labels_run(spark, few_trees):
    rows = QUERIES["fraud_train_score"](spark, SMALL).collect()
    assert rows and {r["prediction"] for r in rows} <= {0, 1}


def test_model_queries_fit_the_operators_defaults(spark, monkeypatch):
    fitted = []

    class Stop(Exception):
        pass

    def note(df, params, *args, **kwargs):
        fitted.append(params)
        raise Stop

    def note_search(train, test, settings=None, n=training.TRIALS, seed=training.SEED):
        fitted.append((settings, n, seed))
        raise Stop

    monkeypatch.setattr(training, "train_gbt", note)
    monkeypatch.setattr(training, "search", note_search)
    for name in (*MODELS, "fraud_train_score"):
        with pytest.raises(Stop):
            QUERIES[name](spark, SMALL)
    default = lambda given: training.TreeParams(positive_weight=given.positive_weight)
    assert fitted == [default(fitted[0]), (None, training.TRIALS, training.SEED), default(fitted[2])]


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0

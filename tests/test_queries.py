"""Every registered query with SQL against DuckDB; and what the plans must not contain."""

import pytest
from oracle import connect, difference

import __spark_entry__ as contract
from tastecore.plans import flows

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
CROSS = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert difference(df, con, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in PYTHON + CROSS if node in plan]


@pytest.mark.parametrize("name,searches", [("binary_experiment", {"logistic": 9, "forest": 72, "tree": 18}), ("multiclass_experiment", {"random forest": 72})])
def test_experiments_search_the_published_grids(spark, monkeypatch, name, searches):
    given = {}
    monkeypatch.setattr(flows, name, lambda df, algorithms, **_: given.update({kind: search for kind, _, search in algorithms}))
    QUERIES[name](spark, SF)
    assert {kind: search and len(search.getEstimatorParamMaps()) for kind, search in given.items()} == searches


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 145 and set(rows[0].asDict()) == {"song_id", "playcount"}

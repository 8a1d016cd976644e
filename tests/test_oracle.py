"""Every registered query against its SQL, on the smallest tables, and its plan."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from adperf.plans import catalogue
from tests.oracle_check import compare, connect

QUERIES, ORACLES = catalogue.QUERIES, catalogue.ORACLES
FORBIDDEN = (
    "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
    got = df.toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert compare(got, want) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert "ad_category" in df.columns and df.count() > 0

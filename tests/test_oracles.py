"""Every registered query against its DuckDB oracle on the smallest test tables."""

import pytest

import __spark_entry__ as E
import check_oracles as C

from conftest import SF_SMALL

# the queries of the optional subpackage have their own tests
QUERIES = E.QUERIES
ORACLES = E.ORACLES


@pytest.fixture(scope="module")
def duck():
    return C.duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    res = C.compare(spark, duck, name, QUERIES[name], ORACLES.get(name), SF_SMALL)
    if name in ORACLES:
        assert res["ok"], res
    else:
        assert res["rows"] >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "errordescription" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_hygiene(spark, name):
    """No cross / nested-loop joins and no row-at-a-time Python UDFs in any registered query."""
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython"):
        assert bad not in plan, f"{name}: {bad}"

"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from tallyfit.catalog import ORACLES, QUERIES

from .oracle import compare, connect

FOLDER = os.environ.get("TALLYFIT_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def check_plan(df):
    """No plan pairs all rows with all rows or calls Python row by row."""
    plan = df._jdf.queryExecution().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    check_plan(df)
    assert compare(df, database, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    check_plan(df)
    assert df.count() > 0


def test_oracles_have_queries():
    assert set(ORACLES) <= set(QUERIES)

"""Every registered query against its checking SQL on the smallest given tables."""

import pytest
from compare import connect, difference, spark_rows, sql_rows
from conftest import DATA, plan_of

import __spark_entry__ as driver
from eodledger.catalog import load_all
from eodledger.catalog.registry import CHECKS, QUERIES

load_all()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_sql(spark, con, name):
    ours = spark_rows(QUERIES[name](spark, DATA))
    assert difference(ours, sql_rows(con, CHECKS[name])) is None


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


def test_driver_lists_them_all():
    assert set(QUERIES) <= set(driver.queries()) and set(CHECKS) <= set(driver.oracle_sql())


def test_entry(spark):
    assert len(driver.entry(spark).columns) == 98


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("report_", "corpus"))])
def test_no_cross_product_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, DATA))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas", "BatchEvalPython"):
        assert unwanted not in plan

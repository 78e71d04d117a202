"""Training-data queries against the SQL of those that SQL can express, over whole tables."""

import pytest
from compare import connect, difference, spark_rows, sql_rows
from conftest import DATA

from eodledger.llm import queries

FOLDERS = (DATA, DATA.replace("sf0.001", "sf0.01"))


@pytest.mark.parametrize("folder", FOLDERS)
@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_equals_its_sql(spark, name, folder):
    ours, theirs = spark_rows(queries.QUERIES[name](spark, folder)), sql_rows(connect(folder), queries.CHECKS[name])
    assert difference(ours, theirs) is None

"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from check_oracle import compare, sql_views
from glyphmill.plans.catalog import QUERIES
from glyphmill.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def views() -> duckdb.DuckDBPyConnection:
    return sql_views(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, views, name):
    found = entry_module.queries()[name](spark, SF_DIR).toPandas()
    wanted = views.execute(entry_module.oracle_sql()[name]).df()
    assert len(found) > 0
    assert compare(found, wanted) == ""


def test_entry(spark):
    assert entry_module.entry(spark).count() == 1

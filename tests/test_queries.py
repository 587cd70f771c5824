"""Every registered query with SQL gives the rows DuckDB gives."""

import pytest

import __spark_entry__ as entry_module
from checks.compare import check, connect

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


def test_entry(spark):
    frame = entry_module.entry(spark)
    assert frame.columns[0] == "customer_id" and len(frame.columns) == 7
    assert frame.count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, folder, connection, name):
    assert check(spark, folder, connection, name) is None

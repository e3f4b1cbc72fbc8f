"""Every registered query against its SQL on another engine."""

import pytest
from compare import differences, duck
from conftest import SMALL

import __spark_entry__ as entry
from firstmile.catalog import oracles, queries

QUERIES = queries.queries()
SQL = oracles.oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql_and_back():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, SQL[name]) == []


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "user_id"
    assert df.count() == 150

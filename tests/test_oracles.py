"""Every catalog query equals its SQL on the supplied tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import differences, duck
from rillmart.catalog import QUERIES
from rillmart.oracle import oracle_sql as mart_sql

NAMES = sorted(QUERIES)
SQL = mart_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_sql():
    assert set(NAMES) == set(SQL)
    assert set(NAMES) <= set(queries()) and SQL.items() <= oracle_sql().items()


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, sf, name):
    assert differences(QUERIES[name](spark, sf), con, SQL[name]) is None


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["stt", "edt"]

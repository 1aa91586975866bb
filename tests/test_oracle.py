"""Every registered query with SQL agrees with it on the smallest tables; the others give rows."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.columns and len(df.collect()) > 0
    else:
        assert compare(df, sql, con) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 3


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())

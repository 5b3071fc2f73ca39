"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_matches_sql(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(entry.queries())

"""Every registered query against its SQL, on the smallest data set."""

import pytest

import __spark_entry__ as entry
from catalog.check import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_against_sql(spark, con, key):
    assert compare(QUERIES[key](spark, SF), con, ORACLE[key]) == ""


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only(spark, key):
    assert QUERIES[key](spark, SF).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 2330
    assert df.columns[-2:] == ["target", "next_price"]
    assert len(df.columns) == 2 + 65 + 1 + 1

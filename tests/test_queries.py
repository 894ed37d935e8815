"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert entry.queries()[name](spark, FOLDER).count() > 0
    else:
        assert difference(spark, con, entry.queries()[name], sql, FOLDER) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "gini" in df.columns

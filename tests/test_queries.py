"""Every registered query against its SQL on whole tables."""

import os

import pytest

import __spark_entry__ as entry
from comparison import difference, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    if name in SQL:
        assert difference(got, con.execute(SQL[name]).df()) is None
    else:
        assert len(got) > 0


def test_entry(spark):
    rows = entry.entry(spark)
    assert "rolling_15m_peak_kW" in rows.columns and rows.count() > 0

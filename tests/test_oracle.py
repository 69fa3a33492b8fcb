"""Every query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, kpi_queries, oracle_sql

from .compare import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(kpi_queries()) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(kpi_queries()))
def test_query(spark, con, name):
    assert compare(kpi_queries()[name](spark, FOLDER), con, oracle_sql()[name]) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "date" and not df.isEmpty()

"""Every registered query against its SQL twin (TEST_SF chooses the scale, sf0.001 by default)."""

import os

import pytest
from compare import DATA, compare, open_duckdb

from __spark_entry__ import entry, oracle_sql, queries

SF = os.environ.get("TEST_SF", "sf0.001")
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return open_duckdb(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_to_sql(name, spark, con):
    assert compare(name, queries()[name], SQL[name], spark, con, SF) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(SQL)))
def test_rows_only(name, spark):
    assert queries()[name](spark, str(DATA / SF)).limit(1).count() == 1


def test_entry(spark):
    assert entry(spark).count() > 3

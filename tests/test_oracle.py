"""Every registered query with a SQL twin matches DuckDB on the same files."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.sql(SQL[name]).df()
    assert compare(got, want) == []


def test_registry_consistent():
    qs = E.queries()
    assert set(SQL) <= set(qs)
    assert len(qs) >= 90

"""Every query with SQL gives the same rows in DuckDB; the others give rows."""

import oracle
import pytest

import __spark_entry__ as entry_points

ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, small, con, name):
    problem = oracle.compare(entry_points.queries()[name](spark, small), con, ORACLES[name])
    assert problem is None, problem


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_points.queries())

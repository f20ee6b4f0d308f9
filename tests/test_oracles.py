"""Every registered query with an oracle, compared value by value with DuckDB."""

import pytest
from conftest import DATA, compare

import __spark_entry__ as entry_point

QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    compare(QUERIES[name](spark, DATA), duck, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert [r["k"] for r in rows] == [0, 1, 2, 3, 4]
    assert all(0 < r["relative_error"] < 1 for r in rows)

"""Every registered query runs; those with a SQL twin agree with it value by value."""

import pytest
from compare import compare, database
from conftest import DATA

import __spark_entry__ as contract

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def base():
    return database(DATA)


def test_contract(spark):
    assert set(SQL) <= set(QUERIES)
    frame = contract.entry(spark)
    assert frame.columns == ["area_code", "seniority_code", "total_jobs", "pct_remote", "reference_date"]


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, base, name):
    frame = QUERIES[name](spark, DATA)
    if name in SQL:
        difference, _ = compare(base, frame, SQL[name])
        assert difference is None, difference
    else:
        assert frame.count() > 0

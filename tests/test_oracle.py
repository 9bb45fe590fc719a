"""Every registered query with an oracle returns the oracle's rows."""

import pytest

import __spark_entry__ as entry

from .compare import compare, oracle_connection

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_oracle(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLE[name]) == ""


def test_names_agree():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["split_counts", "score_requisitions", "importance_time_to_fill_risk"])
def test_rows_only_queries(spark, name):
    assert QUERIES[name](spark, SF).count() > 0

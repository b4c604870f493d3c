"""Every query with SQL must agree with it on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare



@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_matches_sql(spark, sf, con, name):
    assert compare(entry.queries()[name](spark, sf), con, entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in entry.oracle_sql()])
def test_query_without_sql_has_rows(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0

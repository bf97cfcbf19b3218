"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_names_agree():
    assert set(entry.own_queries()) == set(entry.own_sql())


def test_flagship(spark):
    result = entry.entry(spark)
    assert result.columns == [
        "grade", "total_loans", "total_defaults", "default_rate_pct", "avg_interest_rate",
    ]
    assert result.count() == 9


@pytest.mark.parametrize("name", list(entry.own_queries()))
def test_query_equals_sql(spark, sf, con, name):
    rows, problems = compare(entry.own_queries()[name](spark, sf), con, entry.own_sql()[name])
    assert not problems
    assert rows > 0

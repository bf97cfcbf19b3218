from __future__ import annotations

import re

import __spark_entry__ as entry
from gradewise.llm import queries


def test_one_query_for_each_operator():
    names = list(queries.queries())
    assert [re.match(r"op(\d+)_", n).group(1) for n in names if n.startswith("op")] == [str(n) for n in range(1, 14)]
    assert "pipeline" in names and set(queries.oracle_sql()) <= set(names)


def test_the_entry_has_them():
    assert set(entry.queries()) == set(entry.own_queries()) | set(queries.queries())
    assert set(entry.oracle_sql()) == set(entry.own_sql()) | set(queries.oracle_sql())

from __future__ import annotations

import re

import pytest

from gradewise.llm import decontaminate, queries
from tests.llm import plain
from tests.oracle import compare, connect


def expected(docs, items, window=10):
    found: dict[tuple, set] = {}
    for item, text in items:
        w = re.findall(plain.ALNUM, plain.lower(text or ""))
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            found.setdefault(tuple(w[k:k + size]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w = re.findall(plain.ALNUM, plain.lower(text or ""))
        hit, ids = set(), set()
        for size in {len(k) for k in found}:
            for k in range(len(w) - size + 1):
                got = found.get(tuple(w[k:k + size]))
                if got:
                    hit.update(range(k, k + size))
                    ids |= got
        out.append((doc, len(w), len(hit), sorted(ids)))
    return out


def key(row):
    return str(row)


@pytest.fixture
def items(spark):
    w = plain.PROSE.split()
    rows = [(1, plain.PROSE), (1, "fox"), (20, "one two"), (3, None), (4, "... "), (5, " ".join(w[3:15])), (6, " ".join(w[3:15])), (None, "Straße")]
    return spark.createDataFrame(rows, "item_id int, text string")


def test_query_equals_sql(spark, sf):
    rows, problems = compare(queries.op10_decontaminate(spark, sf), connect(sf), queries.oracle_sql()["op10_decontaminate"])
    assert rows and not problems


@pytest.mark.parametrize("block", [8 << 20, 40])
def test_odd_rows(spark, items, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    docs = plain.odd_docs(spark)
    got = [(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in decontaminate.find(docs, items).collect()]
    want = expected([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert sorted(got, key=key) == sorted(want, key=key)
    left = decontaminate.remove(docs, items)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=key) == sorted((d for d, _, hit, _ in want if not hit), key=key)


def test_matches_are_longest(spark):
    words = plain.PROSE.split()
    docs = spark.createDataFrame([(1, "x y " + " ".join(words[2:20]) + " z " + " ".join(words[:12]))], "doc_id int, text string")
    items = spark.createDataFrame([(7, plain.PROSE)], "item_id int, text string")
    row = decontaminate.find(docs, items).first()
    assert [tuple(m) for m in row.matches] == [("7", 2, 20), ("7", 21, 33)]
    assert row.n_hit == 30


def test_nothing(spark, items):
    assert decontaminate.find(plain.no_docs(spark), items).count() == 0
    none = decontaminate.find(plain.odd_docs(spark), items.limit(0))
    assert none.where("n_hit > 0 or size(item_ids) > 0").count() == 0 and none.count() == plain.odd_docs(spark).count()


def test_blocks_come_one_at_a_time(spark, items, plan, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 20)
    docs = plain.odd_docs(spark)
    plans = [plan(decontaminate.find(docs, items)), plan(decontaminate.remove(docs, items))]
    # The passes are over: neither a block nor a step for each is left in the plan of the result.
    assert not any("MapInArrow" in p for p in plans)


def test_equal_items_of_many_blocks_match_once(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 60)
    docs = spark.createDataFrame([(1, "x " + plain.PROSE)], "doc_id int, text string")
    items = spark.createDataFrame([(k, plain.PROSE) for k in range(12)], "item_id int, text string")
    row = decontaminate.find(docs, items).first()
    n = len(plain.PROSE.split())
    assert [tuple(m) for m in row.matches] == [("0", 1, 1 + n)] and row.n_hit == n and row.item_ids == sorted(map(str, range(12)))


def test_matches_by_place_with_any_blocks(spark, monkeypatch):
    words = [f"w{k}" for k in range(40)]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id int, text string")
    items = spark.createDataFrame([(k, " ".join(words[a:b])) for k, (a, b) in enumerate([(22, 32), (0, 10), (11, 21), (0, 10)])], "item_id int, text string")
    for block in (8 << 20, 20):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        row = decontaminate.find(docs, items).first()
        assert [tuple(m)[1:] for m in row.matches] == [(0, 10), (11, 21), (22, 32)]


def test_words_that_a_linear_hash_takes_for_one(spark):
    one, other = plain.thue_morse()
    docs = spark.createDataFrame([(1, other), (2, one)], "doc_id int, text string")
    found = decontaminate.find(docs, spark.createDataFrame([(1, one)], "item_id int, text string"))
    assert {r.doc_id: r.n_hit for r in found.collect()} == {1: 0, 2: 1}

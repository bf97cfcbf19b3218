from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from gradewise.llm import queries, setsketch, tokens
from tests.llm import plain
from tests.oracle import compare, connect


def expected(docs, percent=85):
    sets = []
    for doc, text in docs:
        w = plain.words(plain.lower(text or ""))
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w and doc is not None else set())
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                group[max(root(i), root(j))] = min(root(i), root(j))
    smallest = {}
    for i, (doc, _) in enumerate(docs):
        if sets[i]:
            smallest[root(i)] = min(doc, smallest.get(root(i), doc))
    return [(d, None if d is None else len(sets[i]), smallest[root(i)] if sets[i] else d) for i, (d, _) in enumerate(docs)]


def check(got, docs, percent=85):
    rows = [(r.doc_id, None if r.doc_id is None else r.n_shingles, r.component_id) for r in got]
    assert sorted(rows, key=str) == sorted(expected(docs, percent), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_query_equals_sql(spark, sf):
    rows, problems = compare(queries.op5_setsketch(spark, sf), connect(sf), queries.oracle_sql()["op5_setsketch"])
    assert rows and not problems


def test_odd_rows(spark):
    docs = plain.odd_docs(spark)
    check(setsketch.groups(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    kept = setsketch.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 3, 4, 5, 6, 8, 9, 11, 12, 13, 14, 15, 16, None, None], key=str)
    assert setsketch.groups(plain.no_docs(spark)).count() == 0


@pytest.mark.parametrize("leaders", [512, 2])
def test_chains_and_rings(spark, monkeypatch, leaders):
    """Copies at all distances of one text, of which many are linked only through others."""
    monkeypatch.setattr(setsketch, "LEADERS", leaders)
    monkeypatch.setattr(setsketch, "CHUNK", 16)
    random = np.random.default_rng(5)
    word = lambda: "".join(random.choice(list("abcdefgh"), 4))
    docs, doc = [], 0
    for size in (60, 200):
        text = [word() for _ in range(size)]
        for _ in range(60):
            copy = text.copy()
            for _ in range(int(random.integers(0, size // 12))):
                copy[int(random.integers(size))] = word()
            docs.append((doc, " ".join(copy)))
            doc += 1
            if random.random() < 0.2:
                text = copy
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    check(setsketch.groups(frame).collect(), docs)
    check(setsketch.groups(frame, percent=80).collect(), docs, 80)


def test_estimate():
    random = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.85, 0.95):
        errors = []
        for _ in range(30):
            n = 2000
            both = int(2 * n * share / (1 + share))
            keys = random.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
            rows = setsketch.registers(np.concatenate((keys[:n], keys[n - both:])), np.array([0, n, 2 * n]))
            errors.append(float(setsketch.estimate(rows[:1], rows[1:], np.array([n]), np.array([n]))[0]) - share)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


def test_registers_merge():
    keys = np.random.default_rng(2).integers(0, 1 << 63, 100, dtype=np.uint64)
    rows = setsketch.registers(np.concatenate((keys[:60], keys[60:], keys)), np.array([0, 60, 100, 200]))
    assert (np.maximum(rows[0], rows[1]) == rows[2]).all()


def test_components(spark):
    edges = [(1, 2), (3, 2), (9, 8), (8, 7), (7, 6), (6, 5), (5, 4), (20, 20)]
    got = setsketch.components(spark.createDataFrame(edges, "a long, b long"))
    want = {(1, 1), (2, 1), (3, 1), *((k, 4) for k in range(4, 10))}
    assert {tuple(r) for r in got.collect()} == want
    more = setsketch.joined(got, spark.createDataFrame([(3, 9), (30, 31)], "a long, b long"))
    assert {tuple(r) for r in more.collect()} == {(k, 1) for k in range(1, 10)} | {(30, 30), (31, 30)}


def test_shingles_of_short_texts():
    keys, first = setsketch.shingles(tokens.texts_of(pa.array(["a", "a b", "A B", None, "a b c d e", "b a", "a a a a a a"])))
    assert np.diff(first).tolist() == [1, 1, 1, 0, 1, 1, 1]
    assert keys[1] == keys[2] and len(set(keys.tolist())) == 5


def test_keep_one_by_text(spark):
    """One id with two texts, texts with two ids, rows that differ elsewhere, and a column of a name that is used inside."""
    a, b = plain.PROSE * 3, "quite another text of some more words than five in all"
    rows = [(1, a, 5), (2, a, 1), (2, b, 2), (3, b, 0), (4, "only this one here", 9), (4, "only this one here", 3), (5, "", 1), (5, "", 1), (None, a, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __kept int").selectExpr("*", "doc_id AS kept", "text AS doc")
    got = setsketch.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((tuple(r)[:3] for r in got.collect()), key=str) == sorted(
        [(1, a, 5), (2, b, 2), (4, "only this one here", 3), (5, "", 1), (5, "", 1), (None, a, 7)], key=str,
    )

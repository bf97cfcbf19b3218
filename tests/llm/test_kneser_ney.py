from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest

from gradewise.llm import kneser_ney, queries
from tests.llm import plain

START, END = 1, 0


class Model:
    """The same model, a dictionary at a time."""

    def __init__(self, texts):
        seqs = [self.tokens(t) for t in texts]
        self.count = Counter(w for s in seqs for w in s)
        self.total, self.vocabulary = sum(self.count.values()), len(self.count)
        self.pairs = Counter(p for s in seqs for p in zip([START, *s], s))
        self.context, self.kinds, self.before = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
        for (u, w), n in self.pairs.items():
            self.context[u] += n
            self.kinds[u][min(n, 3) - 1] += 1
            self.before[w] += 1
        self.d = kneser_ney.discounts([sum(n == k for n in self.pairs.values()) for k in (1, 2, 3, 4)])
        self.e = kneser_ney.discounts([sum(n == k for n in self.before.values()) for k in (1, 2, 3, 4)])
        self.left = sum(x * sum(min(n, 3) == k for n in self.before.values()) for k, x in enumerate(self.e, 1))

    @staticmethod
    def tokens(text):
        return [*plain.words(plain.lower(text or "")), END]

    def alone(self, w):
        types = max(1, len(self.pairs))
        n = self.before[w]
        return (n - (self.e[min(n, 3) - 1] if n else 0)) / types + (self.left / types if self.pairs else 1) / (self.vocabulary + 1)

    def chance(self, u, w):
        if not self.context[u]:
            return self.alone(w)
        n = self.pairs[u, w]
        share = sum(a * b for a, b in zip(self.d, self.kinds[u])) / self.context[u]
        return (n - (self.d[min(n, 3) - 1] if n else 0)) / self.context[u] + share * self.alone(w)

    def check(self, row, text):
        s = self.tokens(text)
        base = sum(math.log10((self.count[w] + 1) / (self.total + self.vocabulary + 1)) for w in s)
        score = sum(math.log10(self.chance(u, w)) for u, w in zip([START, *s], s))
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(s), sum(self.count[w] > 0 for w in s), self.total)
        assert row.base_score == pytest.approx(base, rel=1e-9) and row.score == pytest.approx(score, rel=1e-9)


@pytest.mark.parametrize("frequent", [2000, 20])
def test_query(spark, sf, monkeypatch, frequent):
    monkeypatch.setattr(kneser_ney, "FREQUENT", frequent)
    monkeypatch.setattr(kneser_ney, "FLUSH_TOKENS", 5000)
    texts = {r.doc_id: r.text for r in plain.read(spark, sf, "documents").collect()}
    model = Model(t for i, t in texts.items() if not plain.held_out(i, 7, 2))
    assert sum(model.chance("the", w) for w in model.count) + model.chance("the", "unheard of") == pytest.approx(1)
    rows = queries.op2_kneser_ney(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.held_out == plain.held_out(r.doc_id, 7, 2)
        model.check(r, texts[r.doc_id])


def test_odd_rows(spark):
    docs = plain.odd_docs(spark)
    model = Model(r.text for r in docs.collect())
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    rows = kneser_ney.score(docs, kneser_ney.train(docs)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is not None:
            model.check(r, texts[r.doc_id])


def test_without_training(spark):
    model = kneser_ney.train(plain.no_docs(spark))
    rows = kneser_ney.score(plain.odd_docs(spark), model).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in rows} == {(0, 0, 0.0, 0.0)}
    assert kneser_ney.score(plain.no_docs(spark), model).count() == 0

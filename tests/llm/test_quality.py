from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gradewise.llm import labels, learn, queries, quality_rules, rule_ensemble, tokens
from tests.llm import plain


def counts(text):
    w = plain.words(text)
    lines = [x for x in (text or "").split("\n") if plain.words(x)]
    windows = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    hit = {p for k in range(len(w) - 7) if windows[tuple(w[k:k + 8])] > 1 for p in range(k, k + 8)}
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit),
        len(w) < 20 or 100 * len(hit) > 30 * len(w),
    )


def check(got, docs):
    want = sorted(((r.doc_id, *counts(r.text)) for r in docs.collect()), key=str)
    rows = [tuple(r[c] for c in ("doc_id", *quality_rules.COUNTS, "base_failed")) for r in got]
    assert sorted(rows, key=str) == want
    assert all(r.kept == (not r.base_failed and r.probability >= quality_rules.KEEP_AT) for r in got)


def test_base_counts(spark, sf):
    check(queries.op4_quality_rules(spark, sf).collect(), plain.read(spark, sf, "documents"))


def test_odd_rows(spark, sf):
    docs = plain.odd_docs(spark)
    model = quality_rules.train(plain.read(spark, sf, "documents"), plain.read(spark, sf, "labels"))
    got = quality_rules.score(docs, model).collect()
    check(got, docs)
    kept = quality_rules.keep(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)


def test_held_out(spark):
    data = f"{plain_dir()}/sf0.01"
    truth = {r.doc_id: r.quality for r in plain.read(spark, data, "labels").collect()}
    rows = [r for r in queries.op4_quality_rules(spark, data).collect() if r.doc_id in truth and plain.held_out(r.doc_id, 5, 0)]
    good = [r for r in rows if truth[r.doc_id] == 1 and not r.base_failed]
    bad = [r for r in rows if truth[r.doc_id] == 0]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    assert sum(r.kept for r in bad) <= 0.3 * len(bad)


def plain_dir():
    import os

    return os.environ.get("TESTDATA", "/root/testdata")


def test_without_labels(spark, sf):
    docs, none = plain.odd_docs(spark), plain.read(spark, sf, "labels").limit(0)
    model = quality_rules.train(docs, none)
    assert {r.probability for r in quality_rules.score(docs, model).collect()} == {0.5}
    assert quality_rules.score(plain.no_docs(spark), model).count() == 0
    ensemble = rule_ensemble.train(docs, none)
    assert {r.score for r in rule_ensemble.score(docs, ensemble).collect()} == {0.5}
    assert rule_ensemble.score(plain.no_docs(spark), ensemble).count() == 0


def test_sample_is_bounded_and_repeatable(spark, sf):
    docs, rows = plain.read(spark, sf, "documents"), plain.read(spark, sf, "labels")
    once = sorted(r.id for r in labels.sample(docs, rows.unionByName(rows), "quality", rows=20).collect())
    assert len(once) == 20 and once == sorted(r.id for r in labels.sample(docs, rows.repartition(3), "quality", rows=20).collect())
    assert not any(plain.held_out(i, 5, 0) for i in once)


def test_no_label_of_the_largest_test_table_is_left_out(spark):
    data = f"{plain_dir()}/sf0.1"
    rows = plain.read(spark, data, "labels").where("quality is not null").collect()
    ids = {r.doc_id for r in rows if r.doc_id is not None and not plain.held_out(r.doc_id, 5, 0)}
    assert {r.id for r in labels.sample(plain.read(spark, data, "documents"), plain.read(spark, data, "labels"), "quality").collect()} == ids


def test_features_reach_the_driver_whole():
    texts = ["", "word", plain.PROSE * 50, "a" * 70_000, "日本語 " * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts), pa.array([1.0, 0, 1, 0, 1])], names=["id", "text", "label"])
    sent = [r for out in quality_rules._feature_rows(iter([batch])) for r in out.to_pylist()]
    for r, (index, values) in zip(sent, quality_rules.features(tokens.texts_of(batch.column(1))), strict=True):
        assert (np.cumsum(quality_rules._unpacked(r["features"], np.int32), dtype=np.int32) == index).all()
        assert (quality_rules._unpacked(r["values"], np.float32) == values).all()


def test_sums_in_blocks(monkeypatch):
    random = np.random.default_rng(3)
    index = [random.integers(0, 50, n).astype(np.int32) for n in (0, 3, 40, 1, 0, 7)]
    values = [random.random(len(i)).astype(np.float32) for i in index]
    dense = np.zeros((6, 50))
    for row, i, v in zip(dense, index, values):
        np.add.at(row, i, v)
    weights, gradient = random.random(50), random.random(6)
    for size in (1, 5, 1 << 20):
        monkeypatch.setattr(learn, "BLOCK_ENTRIES", size)
        x = learn.Sparse.of(index, values, 50)
        assert np.allclose(x.dot(weights), dense @ weights) and np.allclose(x.back(gradient), gradient @ dense)


@pytest.mark.parametrize("name", ["op3_rule_ensemble"])
def test_rule_ensemble(spark, name):
    data = f"{plain_dir()}/sf0.01"
    truth = {r.doc_id: r.quality for r in plain.read(spark, data, "labels").collect()}
    rows = queries.queries()[name](spark, data).collect()
    assert len(rows) == plain.read(spark, data, "documents").count()
    assert all(r.held_out == plain.held_out(r.doc_id, 5, 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_rules_compile_to_what_they_predict(spark, sf):
    docs = plain.read(spark, sf, "documents").unionByName(plain.odd_docs(spark).select("doc_id", "text", "lang", "source", "n_chars"))
    ensemble = rule_ensemble.train(docs, plain.read(spark, sf, "labels"))
    got = rule_ensemble.score(docs, ensemble).collect()
    x = np.array([[r[s] for s in rule_ensemble.STATISTICS] for r in got])
    assert ensemble.rules and np.allclose(ensemble.predict(x), [r.score for r in got])
    assert all(np.isfinite(r.score) for r in got)


def test_sample_is_bounded_by_rows(spark):
    """Many texts with one labelled id give one row, the same one in any order."""
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(300)] + [(2, None), (2, "b")], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    got = [sorted(map(tuple, labels.sample(d, marks, "quality", rows=2, folds=10**9).collect())) for d in (docs, docs.repartition(5))]
    assert got[0] == got[1] and [r[0] for r in got[0]] == [1, 2]
    assert labels.sample(docs, marks, "quality", rows=1, folds=10**9).count() == 1


def test_bare_symbols_and_lines():
    texts = ["(word) --- a-b !?", "== x", plain.thue_morse()[0] + "\n" + plain.thue_morse()[1]]
    got = rule_ensemble.statistics(tokens.texts_of(pa.array(texts)))
    assert got["bare_symbols"].tolist() == [0.5, 0.5, 0.0] and got["repeated_lines"][2] == 0


def test_id_named_like_a_statistic(spark):
    docs = spark.createDataFrame([("a", "some words here")], "words string, text string")
    ensemble = rule_ensemble.fit(np.random.default_rng(1).random((40, len(rule_ensemble.STATISTICS))), np.arange(40) % 2.0)
    got = rule_ensemble.score(docs, ensemble, id_col="words")
    assert got.columns.count("words") == 1 and got.first().words == "a"


@pytest.mark.parametrize("apart", [0.0, 1.0, 7.0, 40.0])
def test_calibration_of_scores_far_apart(apart):
    raw = np.concatenate((np.linspace(-1, 1, 50) - apart, np.linspace(-1, 1, 30) + apart))
    y = np.arange(80) >= 50
    slope, shift = learn.calibrate(raw, y)
    p = learn.sigmoid(slope * raw + shift)
    assert abs(p.sum() - (30 * 31 / 32 + 50 / 52)) < 1e-3 and (not apart or 0 < slope < 100)
    assert apart < 7 or (p[50:] > 0.9).all() and (p[:50] < 0.1).all()

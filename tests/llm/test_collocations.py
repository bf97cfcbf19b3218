from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradewise.llm import collocations, queries
from tests.llm import plain
from tests.oracle import compare, connect

DOCS = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("w1", T.StringType()), ("f", T.LongType()), ("n", T.StringType()),
    ("last", T.BooleanType()), ("chunk", T.StringType()),
)])


def grams(rows) -> Counter:
    found = Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", plain.lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                found.update(("und" if lang is None else lang, *w[i: i + k]) for i in range(len(w) - k + 1))
    return found


def ranking(rows, least, top):
    found = grams(rows)
    candidates = {g: a for g, a in found.items() if len(g) > 2 and a >= least}
    dropped = {(g[0], *part) for g, a in candidates.items() if len(g) == 4 for part in (g[1:3], g[2:4]) if 100 * a >= 50 * found[(g[0], *part)]}
    totals = Counter()
    for g, a in found.items():
        totals[g[0]] += a if len(g) == 2 else 0
    out = {}
    for g, a in candidates.items():
        if g in dropped:
            continue
        cuts = [(1_000_000 * a * a // (found[(g[0], *g[1: 1 + k])] * found[(g[0], *g[1 + k:])]), k) for k in range(1, len(g) - 1)]
        score, k = min(cuts)
        out.setdefault(g[0], []).append((" ".join(g[1:]), a, found[(g[0], *g[1: 1 + k])], found[(g[0], *g[1 + k:])], score))
    return sorted(
        (lang, i + 1, phrase, a, l, r, totals[lang], s)
        for lang, own in out.items() for i, (phrase, a, l, r, s) in enumerate(sorted(own, key=lambda x: (-x[4], -x[1], x[0].encode()))[:top])
    )


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf, size):
    folder = sf.replace("sf0.001", size)
    rows, problems = compare(queries.op11_collocations(spark, folder), connect(folder), queries.oracle_sql()["op11_collocations"])
    assert not problems and rows > 0


def odd_rows():
    rng = np.random.default_rng(5)
    words = ["New", "york", "CITY", "Ünï", "日本", "\x00", "it's", "a", "b", "c", "a b", "x" * 3000]
    rows = [(" ".join(rng.choice(words, rng.integers(0, 60))), str(rng.choice(["en", "d e", "", "und"]))) for _ in range(120)]
    rows += [(None, "en"), ("", None), ("  \t ", "en"), ("one", None), ("new york city. " * 3000, "en"), ("a\tb  c,a b\nc\x0bd\x0ce\rf;g:h!i?j", None)]
    rows += [("the same line of words again and again\n" * 15, None)] * 4 + [("no punctuation " * 20_000, "en")]
    return rows


@pytest.mark.parametrize(("cut_one_in", "flush"), [(8, 1_000_000), (1, 50), (1_000_000, 200)])
def test_odd_rows(spark, monkeypatch, cut_one_in, flush):
    monkeypatch.setattr(collocations, "FLUSH_WORDS", flush)
    monkeypatch.setattr(collocations, "MERGE_ROWS", flush)
    rows = odd_rows()
    docs = spark.createDataFrame([(k, t, l, "clash", 1, "clash", True, "clash") for k, (t, l) in enumerate(rows)], DOCS)
    for least, top in ((3, 25), (10, 2000)):
        got = collocations.mine(docs, least=least, top=top, cut_one_in=cut_one_in, buckets=5)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == ranking(rows, least, top)


def test_no_rows(spark):
    assert collocations.mine(spark.createDataFrame([], DOCS)).count() == 0
    assert collocations.mine(spark.createDataFrame([(1, "a few words, each once", "en", None, None, None, None, None)], DOCS)).count() == 0


def test_dictionary_counts_equal_chunks_once(spark):
    docs = spark.createDataFrame([(k, "some words that are the same everywhere in this one passage of text and so on", "en", None, None, None, None, None) for k in range(50)], DOCS)
    parsed = collocations.parse(docs)
    rows = parsed.collect()
    assert {r.n for r in rows} == {50} and len(rows) == len({r.chunk for r in rows})
    # Words less the overlaps are the text's words.
    assert sum(r.n * (len(r.chunk.split()) - (0 if r.last else collocations.OVERLAP)) for r in rows) == 50 * 16


def test_numbers_beyond_21_bits():
    keys = np.array([[1 << 22, 5, 0], [3, 1, 2], [1 << 22, 5, 0], [3, 1, 0]])
    got, counts = collocations.added(keys, np.array([1, 2, 3, 4]))
    assert got.tolist() == [[3, 1, 0], [3, 1, 2], [1 << 22, 5, 0]] and counts.tolist() == [4, 2, 4]


def test_score_is_exact(spark):
    rows = [(3_000_000_000_000, 3_000_000_000_001, 3_000_000_000_007), (10**15, 10**15, 10**15), (10, 1000, 10**15), (7, 7, 9), (999_999, 1_000_000, 999_999)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", collocations.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert [r.s for r in got] == [1_000_000 * a * a // (l * r) for a, l, r in rows]

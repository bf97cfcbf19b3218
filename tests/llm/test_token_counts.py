from __future__ import annotations

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from gradewise.llm import queries, token_counts
from tests.llm import plain


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=token_counts.vocabulary_path())


@pytest.fixture(scope="module")
def cutter():
    return token_counts.Pieces(token_counts.vocabulary_path())


def test_query_equals_library(spark, sf, library):
    texts = {r.doc_id: r.text or "" for r in plain.read(spark, sf, "documents").collect()}
    rows = queries.op12_token_counts(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(library.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


@settings(deadline=None, max_examples=500)
@given(st.text(st.sampled_from("abein  ▁\n\t\r.,<s>/unk0x​İÄéß日😀\x00\x1c\u0085　"), max_size=40))
def test_any_text(cutter, library, text):
    found = cutter.split(text)
    assert sum(n * k for n, k in zip(found.values(), cutter.sizes(list(found)))) == len(library.encode(text))


@pytest.mark.parametrize("text", ["<s> </s> <unk><0x0A>", " " * 1000, "a" * 30_000, "\n\n\n", "▁▁a▁", "x  \n  y", "日本語" * 2000])
def test_chosen_texts(cutter, library, text, monkeypatch):
    want = len(library.encode(text))
    for long in (1 << 20, 10):
        monkeypatch.setattr(token_counts, "LONG_TEXT", long)
        found = cutter.split(text)
        assert sum(n * k for n, k in zip(found.values(), cutter.sizes(list(found)))) == want


@pytest.mark.parametrize("chunk_bytes", [token_counts.CHUNK_BYTES, 300])
def test_odd_rows(spark, library, chunk_bytes):
    docs = plain.odd_docs(spark)
    want = sorted((str(r.doc_id), len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in docs.collect())
    got = token_counts.count(docs, chunk_bytes=chunk_bytes, buckets=7)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got.collect()) == want
    assert token_counts.count(plain.no_docs(spark)).count() == 0


def test_frequent_words_and_many_rows(spark, library):
    # More rows than numbers of 16 bits tell apart, one word in all of them, copies, string ids.
    n = token_counts.CHUNK_ROWS + 4000
    docs = spark.range(n, numPartitions=1).selectExpr("concat('d', id % 1000) AS name", "concat('the the ', id % 7, repeat(' ', cast(id % 3 AS int))) AS body")
    want = {}
    for r in docs.collect():
        want[r.body] = want.get(r.body) or len(library.encode(r.body))
    got = token_counts.count(docs, id_col="name", text_col="body", buckets=3)
    assert got.count() == n
    assert got.groupBy().sum("n_tokens").first()[0] == sum(want[r.body] for r in docs.collect())


def test_vocabulary_whose_pieces_reach_over_spaces_is_refused(monkeypatch):
    class Odd(sentencepiece.SentencePieceProcessor):
        def id_to_piece(self, i):
            return "a▁b" if i == 300 else super().id_to_piece(i)

    monkeypatch.setattr(token_counts.sentencepiece, "SentencePieceProcessor", Odd)
    with pytest.raises(ValueError, match="reaches over a space"):
        token_counts.Pieces(token_counts.vocabulary_path())

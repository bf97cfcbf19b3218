from __future__ import annotations

import hashlib
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gradewise.llm import bpe, queries
from tests.llm import plain


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary_path())


@pytest.fixture(scope="module")
def coder():
    return bpe.Encoder(bpe.vocabulary_path())


def test_query_equals_library(spark, sf, library):
    texts = {r.doc_id: r.text for r in plain.read(spark, sf, "documents").collect()}
    rows = queries.op7_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == plain.sha256(library.decode(ids, skip_special_tokens=False))


@settings(deadline=None, max_examples=400)
@given(st.text(st.sampled_from("abeinorst  .,!'<|>endoftextÄéßΣσİ½²٣日😀​\u0085ᲀ\x1c\x00"), max_size=40))
def test_any_text(coder, library, text):
    assert coder.encode_all([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["<|endoftext|>a b<|startoftext|>", "'s'S don't 'll''ve", "a" * 30_000, "é ﬁ Å", "<|end"])
def test_chosen_texts(coder, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert coder.encode_all([text, "", None, text])[0].tolist() == want * 2
    assert coder.encode(text).tolist() == want


def test_odd_rows(spark, library):
    docs = plain.odd_docs(spark)
    rows = bpe.encode(docs).collect()
    texts = [r.text or "" for r in docs.collect()]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted((str(r.doc_id), list(r.ids)) for r in rows) == sorted((str(d.doc_id), i) for d, i in zip(docs.collect(), want))
    again = bpe.decode(bpe.encode(docs)).collect()
    assert sorted(r.decoded for r in again) == sorted(library.decode(i, skip_special_tokens=False) for i in want)
    assert bpe.encode(plain.no_docs(spark)).count() == 0


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id int, ids array<int>")
    assert [r.decoded for r in bpe.decode(rows).collect()] == ["", ""]


def test_known_pieces_are_forgotten_in_time(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    fresh = bpe.Known()
    monkeypatch.setattr(coder, "known", fresh)
    for text in ("a b c", "d e f g h", "a d", *plain.thue_morse()):
        assert coder.encode_all([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_pieces_with_one_hash_are_told_apart(coder, library, monkeypatch):
    monkeypatch.setattr(coder, "known", bpe.Known())
    true = bpe.split
    monkeypatch.setattr(bpe, "split", lambda text: (*(t := true(text))[:2], np.zeros_like(t[2]), t[3]))
    for text in ("one two three two", "four", "one"):
        assert coder.encode_all([text, "five"])[0].tolist() == [i for t in (text, "five") for i in library.encode(t, add_special_tokens=False).ids]


def test_memory_of_a_worker_is_bounded():
    """MB that a process grows by at its peak: the vocabulary's tables, then twelve MB of texts. An executor holds one such worker for each core."""
    code = """if True:
        import numpy as np, pyarrow as pa, re
        from gradewise.llm import bpe
        most = lambda: int(re.search(r"VmHWM:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024
        rng = np.random.default_rng(5)
        words = ["".join(w) for w in rng.choice(list("abcdefghinorst"), (20_000, 7))]
        texts = pa.array([" ".join(words[i] for i in rng.integers(0, len(words), 300)) for _ in range(5_000)])
        before = most()
        coder = bpe.Encoder(bpe.vocabulary_path())
        tables = most() - before
        for a, b in bpe._slices(texts):
            coder.encode_all(texts.slice(a, b - a).to_pylist())
        print(tables, most() - before)"""
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], capture_output=True, text=True, check=True, timeout=300).stdout
    tables, peak = map(float, out.split())
    assert tables < 45 and peak < 120, out

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from gradewise.llm import tokens
from tests.llm import plain

TEXTS = st.lists(st.none() | st.text("aAbB \n\té€ .0", max_size=30), max_size=8)


@settings(deadline=None, max_examples=200)
@given(TEXTS, st.integers(1, 40))
def test_words_and_hashes(texts, limit):
    column = pa.array(texts, pa.string())
    seen, found, rows = {}, [], 0
    for a, b, part in tokens.chunks(column, limit):
        assert a == rows
        rows = b
        starts, ends, first = part.spans(tokens.IS_WORD)
        hashes = part.hashes(starts, ends, tokens.LOWER_CODES).tolist()
        data = part.data.tobytes()
        for i in range(b - a):
            own = [(data[s:e].decode(), h) for s, e, h in zip(starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]], hashes[first[i]:first[i + 1]])]
            found.append([w for w, _ in own])
            for word, h in own:
                assert seen.setdefault(plain.lower(word), h) == h
    assert rows == len(texts)
    assert found == [plain.words(t) for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_alnum_words():
    text = "A-b_c ÄÖ9 \x00x€\x7fy"
    texts = tokens.texts_of(pa.array([text]))
    starts, ends, _ = texts.spans(tokens.IS_ALNUM)
    assert [texts.data[s:e].tobytes().decode().lower() for s, e in zip(starts, ends)] == re.findall(plain.ALNUM, plain.lower(text).lower())


def test_windows_stay_in_a_text():
    texts = tokens.texts_of(pa.array(["a b c", None, "a b", "a b c d"]))
    starts, ends, first = texts.spans(tokens.IS_WORD)
    keys, at = tokens.windows(texts.hashes(starts, ends), first, 3)
    assert at.tolist() == [0, 5, 6] and keys[0] == keys[1] != keys[2]
    assert [x.tolist() for x in tokens.repeated(np.array([3, 1, 3, 2, 3], np.uint64))] == [
        [True, False, True, False, True], [False, False, True, False, True],
    ]


def test_sliced_column():
    column = pa.array(["no", "a b", "c"]).slice(1)
    assert tokens.texts_of(column).data.tobytes() == b"a bc"


def test_hash_is_not_linear():
    for length in (1024, 4096, 1 << 15):
        texts = tokens.texts_of(pa.array(plain.thue_morse(length)))
        one, other = texts.hashes(texts.bounds[:-1], texts.bounds[1:])
        assert one != other


def test_hash_of_any_cut(monkeypatch):
    """The same for a word wherever it lies, however the work is cut, and in any order of the slices."""
    words = ["", "a", "ab", "b" * 50, "ab", "", "a"]
    texts = tokens.texts_of(pa.array(words))
    starts, ends = texts.bounds[:-1], texts.bounds[1:]
    want = texts.hashes(starts, ends)
    assert want[2] == want[4] and want[0] == want[5] and want[1] == want[6] and len(set(want.tolist())) == 4
    order = np.array([3, 1, 2, 6])
    assert texts.hashes(starts[order], ends[order]).tolist() == want[order].tolist()
    for size in (1, 7):
        monkeypatch.setattr(tokens, "CHUNK_BYTES", size)
        assert texts.hashes(starts, ends).tolist() == want.tolist()

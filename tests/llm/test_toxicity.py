from __future__ import annotations

import numpy as np
import pyarrow as pa

from gradewise.llm import queries, tokens, toxicity
from tests.llm import plain
from tests.llm.test_quality import plain_dir


def words_of(texts):
    return toxicity.Words.of(tokens.texts_of(pa.array(texts, pa.large_string())))


def small_network(words):
    keys = words.keys[::2]
    return toxicity.Network.fresh(keys, np.linspace(-1, 1, len(keys)).astype(np.float32), np.sort(words.stems[:1, 0]), np.ones(1, np.float32))


def test_gradients():
    words = words_of(["a bad word here", "some clean text with more words than this " * 9, "x"])
    network = small_network(words)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    (span, offset), y, weigh = words.around(*words.windows()), np.array([1.0, 0, 1, 0, 1, 0]), np.array([1.0, 2, 0.5, 1, 1, 3])

    def loss():
        raw = network.forward(network.inputs(words), span, offset)[0].astype(float)
        return (weigh * (np.logaddexp(0, raw) - y * raw)).mean()

    for name, g in network.gradients(words, span, offset, y, weigh).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        value = network.p[name][at]
        network.p[name][at] = value + 0.01
        up = loss()
        network.p[name][at] = value - 0.01
        down = loss()
        network.p[name][at] = value
        assert abs((up - down) / 0.02 - g[at]) < 0.01 * abs(g[at]) + 1e-5, name


def test_windows_cover_every_word():
    texts = ["", None, "w " * 5, "w " * 32, "w " * 33, "w " * 500]
    words = words_of(texts)
    start, owner = words.windows()
    assert sorted(set(owner.tolist())) == [2, 3, 4, 5]
    for i, n in enumerate(np.diff(words.first)):
        covered = {int(p) for s in start[owner == i] for p in range(s, min(s + toxicity.WINDOW, words.first[i + 1]))}
        assert len(covered) == n


def plain_scores(network, x, texts):
    """Each window's raw score, word by word and window by window; `texts` are lists of rows of `x`."""
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    p, size = {k: v.astype(float) for k, v in network.p.items()}, toxicity.HIDDEN

    def state(name, words):
        h = np.zeros(size)
        for w in words:
            g, u = x[w] @ p[f"{name}_in"] + p[f"{name}_bias"], h @ p[f"{name}_state"]
            z, r = sigmoid(g[:size] + u[:size]), sigmoid(g[size: 2 * size] + u[size: 2 * size])
            h = z * h + (1 - z) * np.tanh(g[2 * size:] + r * u[2 * size:])
        return h

    out = []
    for words in texts:
        states = []
        for k in range(len(words)):
            segment = k // toxicity.SEGMENT * toxicity.SEGMENT
            before = words[max(0, segment - toxicity.LEAD): k + 1]
            after = words[k: segment + toxicity.SEGMENT + toxicity.LEAD]
            states.append(np.concatenate((state("forth", before), state("back", after[::-1]))))
        for k in range(max(1, len(words) - toxicity.WINDOW + 1) if words else 0):
            part = np.array(states[k: k + toxicity.WINDOW])
            weight = np.exp(np.tanh(part @ p["look"]) @ p["query"])
            out.append((weight / weight.sum()) @ part @ p["out"] + p["offset"][0])
    return np.array(out)


def test_every_window_against_a_plain_forward_pass(monkeypatch):
    random = np.random.default_rng(5)
    lists = [["".join(random.choice(list("abcdefg"), 4)) for _ in range(n)] for n in (0, 1, 31, 32, 0, 33, 47, 64, 65, 100, 200, 0)]
    words = words_of([" ".join(w) for w in lists])
    network = small_network(words)
    texts = [words.which[a:b].tolist() for a, b in zip(words.first, words.first[1:])]
    expected = plain_scores(network, network.inputs(words).astype(float), texts)
    for block in (1, 3, 2048):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        raw, best = network.highest(words)
        assert len(raw) == len(expected) == sum(max(1, len(w) - 31) for w in lists if w)
        assert np.abs(raw - expected).max() < 1e-5
        ends = np.cumsum([max(1, len(w) - 31) if w else 0 for w in lists])
        assert all(np.isinf(b) if not w else b == raw[e - max(1, len(w) - 31): e].max() for b, w, e in zip(best, lists, ends))
    # Training sees the same scores.
    start, owner = words.windows(1)
    assert np.abs(network.forward(network.inputs(words), *words.around(start, owner))[0] - expected).max() < 1e-5


def test_held_out(spark):
    data = f"{plain_dir()}/sf0.1"
    truth = {r.doc_id: r.toxic for r in plain.read(spark, data, "labels").collect()}
    rows = queries.op6_toxicity(spark, data).collect()
    assert len(rows) == 10_000
    assert all(r.held_out == plain.held_out(r.doc_id, 5, 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    toxic, clean = ([r for r in held if truth[r.doc_id] == k] for k in (1, 0))
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)


def test_odd_rows(spark):
    docs = plain.odd_docs(spark)
    texts = [f"{plain.PROSE} {'you awful fool' if k % 2 else 'you fine friend'} {k}" for k in range(60)]
    network = toxicity.fit(texts, np.arange(60) % 2.0)
    got = toxicity.score(docs, network).collect()
    assert len(got) == docs.count()
    assert all(r.score == 0 for r in got if r.doc_id in (3, 4, 5, 13)) and all(0 <= r.score <= 1 for r in got)
    same = [r.score for r in got if r.doc_id in (1, 2)]
    assert max(same) == min(same)
    far = spark.createDataFrame([(1, plain.PROSE * 300 + " you awful fool " + plain.PROSE * 300), (2, plain.PROSE * 600)], "doc_id int, text string")
    assert {r.doc_id: r.predicted for r in toxicity.score(far, network).collect()} == {1: 1, 2: 0}


def test_without_labels(spark, sf):
    docs, none = plain.odd_docs(spark), plain.read(spark, sf, "labels").limit(0)
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, none)).collect()} == {0.0}
    assert toxicity.score(plain.no_docs(spark), None).count() == 0

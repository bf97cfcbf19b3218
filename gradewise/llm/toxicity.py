"""Toxicity by a bidirectional gated recurrent network with attention pooling, over overlapping windows of words.

A word enters as a learned vector of its own (if it is common enough in training), the mean of learned vectors of its
hashed character trigrams, and how much its beginnings of `STEMS` bytes tell toxic texts from clean ones. Two gated recurrent
layers read the text once, one in each direction: in segments of `SEGMENT` words from the text's first one on, each with a lead-in
of `LEAD` words on the side where the layer begins. Attention pools the states of a window of `WINDOW` words and a logistic
unit scores the pool. A text's score is the highest of all its windows', which begin at every word, calibrated on the training
sample's. Since a window's pool is a quotient of two sums over its words, all windows cost a few additions a word. The network
learns from windows that begin every `STRIDE` words, through the same segments. Everything is numpy: training on the driver over a
bounded sample of labelled texts (`TOXIC_ROWS`, `CLEAN_ROWS`, each of at most `TRAIN_BYTES`), scoring in Arrow batches without a shuffle.

A label says only that something in a text is toxic. Training starts from windows with the words that tell toxic from clean
texts best and, in later rounds, takes each toxic text's highest window and the clean texts' highest windows.

Defined results: a text without letters (null and empty ones too) scores 0; without labels of both kinds every text
scores 0; repeated rows score alike; other columns and labels are never read when scoring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewise.llm import labels as labelled
from gradewise.llm import learn, tokens

TOXIC_ROWS = 1200
CLEAN_ROWS = 1800
TRAIN_BYTES = 16 << 10
# A power of two, see `window_sums`.
WINDOW = 32
STRIDE = 16
# At least WINDOW, so that a window lies in two segments at most.
SEGMENT = 32
LEAD = 16
WORD_SIZE = CHAR_SIZE = 8
HIDDEN = 8
CHAR_BUCKETS = 1 << 12
LEAST_TEXTS = 3
BY_CHANCE = 4.0
STEMS = range(4, 13)
CLEAN_WINDOWS = 4
BARE = 0.5
MIXED = 0.5
ROUNDS, EPOCHS, BATCH = 3, 4, 128
# A small sample is gone over more often, up to so many steps a round.
LEAST_STEPS = 60
PREDICT_AT = 0.5
BLOCK = 2048

IS_LETTER = np.zeros(256, bool)
IS_LETTER[0x41:0x5B] = IS_LETTER[0x61:0x7B] = IS_LETTER[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def trigrams(texts: tokens.Texts, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each trigram, where each word's begin); a word has its edges as characters too."""
    sizes = ends - starts
    first = np.concatenate(([0], np.cumsum(sizes)))
    place = np.arange(first[-1]) - np.repeat(first[:-1], sizes)
    at = np.repeat(starts, sizes) + place
    data = LOWER[texts.data].astype(np.uint32)
    here = data[at]
    before = np.where(place > 0, data[np.maximum(at - 1, 0)], 2)
    after = np.where(place < np.repeat(sizes, sizes) - 1, data[np.minimum(at + 1, len(data) - 1)], 3)
    mixed = ((before << np.uint32(16)) | (here << np.uint32(8)) | after) * np.uint32(0x9E3779B1)
    return (mixed >> np.uint32(20)).astype(np.int32), first


@dataclass
class Words:
    """The distinct words of some texts, and the texts as places in them."""

    keys: np.ndarray
    stems: np.ndarray  # a row for each word: the hash of each of its beginnings, 0 where it is no longer than that
    grams: np.ndarray
    gram_first: np.ndarray
    which: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: tokens.Texts) -> Words:
        starts, ends, first = texts.spans(IS_LETTER)
        hashes = texts.hashes(starts, ends, tokens.LOWER_CODES)
        keys, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        grams, gram_first = trigrams(texts, starts[at], ends[at])
        starts, sizes = starts[at], (ends - starts)[at]
        stems = [texts.hashes(starts, starts + np.minimum(k, sizes), tokens.LOWER_CODES) * (sizes > k) for k in STEMS]
        return cls(keys, np.stack(stems, 1), grams, gram_first, which, first)

    def windows(self, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
        """(start of each window, its text): as many as cover every word, none of a text without words."""
        n = np.diff(self.first)
        many = np.where(n > 0, np.maximum(1, -(-(n - (WINDOW - stride)) // stride)), 0)
        owner = np.repeat(np.arange(len(n)), many)
        rank = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return self.first[owner] + stride * rank, owner

    def segments(self) -> tuple[np.ndarray, np.ndarray]:
        """(start of each segment, its text)"""
        n = np.diff(self.first)
        many = -(-n // SEGMENT)
        owner = np.repeat(np.arange(len(n)), many)
        rank = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return self.first[owner] + SEGMENT * rank, owner

    def rows(self, start: np.ndarray, owner: np.ndarray, places: range) -> np.ndarray:
        """Word at each of these places from the starts, -1 outside the text."""
        at = start[:, None] + np.arange(places.start, places.stop)
        inside = (at >= self.first[owner][:, None]) & (at < self.first[1:][owner][:, None])
        return np.where(inside, self.which[np.clip(at, 0, len(self.which) - 1)], -1)

    def around(self, start: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words of the two segments that hold a window, with both lead-ins; place of the window behind the first lead-in)"""
        offset = (start - self.first[owner]) % SEGMENT
        return self.rows(start - offset, owner, range(-LEAD, 2 * SEGMENT + LEAD)), offset

    def window_sums(self, values: np.ndarray, start: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Sum of each window's values, by doubling: nothing is subtracted, so small values beside large ones keep their digits."""
        sums, width = np.concatenate((values, np.zeros(WINDOW - 1))), 1
        while width < WINDOW:
            sums = sums[:-width] + sums[width:]
            width *= 2
        n = np.diff(self.first)
        whole = np.zeros(len(n))
        whole[n > 0] = np.add.reduceat(values, self.first[:-1][n > 0])
        return np.where(n[owner] < WINDOW, whole[owner], sums[start])


def _gram_means(words: Words, table: np.ndarray) -> np.ndarray:
    sums = np.add.reduceat(table[words.grams], words.gram_first[:-1], axis=0) if len(words.grams) else table[:0]
    return sums / np.maximum(np.diff(words.gram_first), 1)[:, None]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.minimum(-x, 80)))


def _tanh(x: np.ndarray) -> np.ndarray:
    """By way of the exponential, which numpy computes several times as fast as np.tanh for 32-bit floats."""
    return 2 / (1 + np.exp(np.minimum(-2 * x, 80))) - 1


def _gates(name: str, p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return p[f"{name}_in"], p[f"{name}_state"], p[f"{name}_bias"]


def _run(inputs: np.ndarray, mask: np.ndarray, state_weights: np.ndarray, backward: bool, keep: bool) -> tuple[np.ndarray, list]:
    """States of one layer: `inputs` (place, segment, 3 * HIDDEN) hold the input's share of update, reset and candidate."""
    length, n = mask.shape
    h = np.zeros((n, HIDDEN), np.float32)
    states = np.empty((length, n, HIDDEN), np.float32)
    tape = []
    for t in range(length - 1, -1, -1) if backward else range(length):
        g = inputs[t]
        u = h @ state_weights
        gate = _sigmoid(g[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
        z, r = gate[:, :HIDDEN], gate[:, HIDDEN:]
        candidate = _tanh(g[:, 2 * HIDDEN:] + r * u[:, 2 * HIDDEN:])
        new = candidate + z * (h - candidate)
        m = mask[t, :, None]
        if keep:
            tape.append((t, h, z, r, candidate, u[:, 2 * HIDDEN:]))
        h = np.where(m, new, h)
        states[t] = h
    return states, tape


def _back(tape: list, mask: np.ndarray, state_weights: np.ndarray, d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of `_run`'s inputs and state weights."""
    length, n = mask.shape
    d_inputs = np.zeros((length, n, 3 * HIDDEN), np.float32)
    d_weights = np.zeros_like(state_weights)
    d_h = np.zeros((n, HIDDEN), np.float32)
    for t, h, z, r, candidate, u in reversed(tape):
        d = d_h + d_states[t]
        m = mask[t, :, None]
        active = np.where(m, d, 0)
        d_z = active * (h - candidate) * z * (1 - z)
        d_c = active * (1 - z) * (1 - candidate * candidate)
        d_r = d_c * u * r * (1 - r)
        d_u = np.concatenate((d_z, d_r, d_c * r), 1)
        d_inputs[t] = np.concatenate((d_z, d_r, d_c), 1)
        d_weights += h.T @ d_u
        d_h = np.where(m, active * z, d) + d_u @ state_weights.T
    return d_inputs, d_weights


LAYERS = ("forth", "back")
# Places of a segment that each layer reads, and where the segment itself lies among them.
READS = {"forth": range(-LEAD, SEGMENT), "back": range(SEGMENT + LEAD)}
CORE = {"forth": slice(LEAD, LEAD + SEGMENT), "back": slice(0, SEGMENT)}


def _both(span: np.ndarray, name: str) -> np.ndarray:
    """What a layer reads of the two segments of each row of `Words.around`: (place, 2 * row + segment)."""
    reads = READS[name]
    parts = [span[:, LEAD + k + reads.start: LEAD + k + reads.stop] for k in (0, SEGMENT)]
    return np.stack(parts, 1).reshape(-1, len(reads)).T


@dataclass
class Network:
    keys: np.ndarray  # sorted hashes of the words with a vector; row 0 is that of all others
    stems: np.ndarray  # sorted hashes of the beginnings that tell anything, and how much
    stems_tell: np.ndarray
    p: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0

    @classmethod
    def fresh(cls, keys: np.ndarray, telling: np.ndarray, stems: np.ndarray, stems_tell: np.ndarray) -> Network:
        random = np.random.default_rng(7)

        def around(*shape: int, size: float) -> np.ndarray:
            return random.normal(0, size, shape).astype(np.float32)

        inputs = WORD_SIZE + CHAR_SIZE + 1
        p = {"words": around(len(keys) + 1, WORD_SIZE, size=0.02), "chars": around(CHAR_BUCKETS, CHAR_SIZE, size=0.02)}
        # The first number of a word's vector starts as how much it tells toxic texts from clean ones.
        p["words"][0] = 0
        p["words"][1:, 0] = telling
        for name in LAYERS:
            p[f"{name}_in"] = around(inputs, 3 * HIDDEN, size=inputs**-0.5)
            p[f"{name}_state"] = around(HIDDEN, 3 * HIDDEN, size=HIDDEN**-0.5)
            p[f"{name}_bias"] = np.zeros(3 * HIDDEN, np.float32)
        p |= {"look": around(2 * HIDDEN, HIDDEN, size=0.3), "query": around(HIDDEN, size=0.5), "out": around(2 * HIDDEN, size=0.5),
              "offset": np.full(1, -1.0, np.float32)}
        return cls(keys, stems, stems_tell, p)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Row of `words` for each hash."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at + 1, 0)

    def inputs(self, words: Words) -> np.ndarray:
        stems = stems_telling(words.stems, self.stems, self.stems_tell)
        return np.concatenate((self.p["words"][self.places(words.keys)], _gram_means(words, self.p["chars"]), stems[:, None]), 1)

    def layer(self, name: str, table: np.ndarray, rows: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """States of a layer at `rows` (place, segment) of words; `table` holds each word's share of the gates."""
        return _run(table[np.maximum(rows, 0)], rows >= 0, self.p[f"{name}_state"], name == "back", keep)

    def shares(self, name: str, x: np.ndarray) -> np.ndarray:
        weights, _, bias = _gates(name, self.p)
        return x @ weights + bias

    def states(self, words: Words) -> np.ndarray:
        """States of both layers at every word."""
        start, owner = words.segments()
        x = self.inputs(words)
        out = np.empty((len(words.which), 2 * HIDDEN), np.float32)
        tables = [self.shares(name, x) for name in LAYERS]
        for k in range(0, len(start), BLOCK):
            some = slice(k, k + BLOCK)
            rows = words.rows(start[some], owner[some], range(SEGMENT))
            here = slice(start[some][0], min(start[some][-1] + SEGMENT, words.first[owner[some][-1] + 1]))
            for layer, name in enumerate(LAYERS):
                got = self.layer(name, tables[layer], words.rows(start[some], owner[some], READS[name]).T)[0]
                out[here, layer * HIDDEN: (layer + 1) * HIDDEN] = got[CORE[name]].transpose(1, 0, 2)[rows >= 0]
        return out

    def forward(self, x: np.ndarray, span: np.ndarray, offset: np.ndarray, keep: bool = False):
        """Raw scores of the windows of `Words.around` over word inputs `x`."""
        p = self.p
        window = (np.arange(len(span))[:, None], offset[:, None] + np.arange(WINDOW))
        mask = span[:, LEAD:][window] >= 0
        states, tapes = [], []
        for name in LAYERS:
            s, tape = self.layer(name, self.shares(name, x), _both(span, name), keep)
            states.append(s[CORE[name]].transpose(1, 0, 2).reshape(len(span), 2 * SEGMENT, HIDDEN)[window])
            tapes.append(tape)
        h = np.concatenate(states, 2)
        look = _tanh(h @ p["look"])
        weight = np.where(mask, np.exp(look @ p["query"]), 0)
        weight /= np.maximum(weight.sum(1, keepdims=True), 1e-30)
        pool = (weight[:, None] @ h)[:, 0]
        return pool @ p["out"] + p["offset"][0], (window, tapes, h, look, weight, pool)

    def gradients(self, words: Words, span: np.ndarray, offset: np.ndarray, y: np.ndarray, weigh: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        used, at = np.unique(span, return_inverse=True)
        span = at.reshape(span.shape) - (used[0] < 0)
        used = used[used >= 0]
        sizes = np.diff(words.gram_first)[used]
        gram_at = np.repeat(words.gram_first[:-1][used] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        part = Words(words.keys[used], words.stems[used], words.grams[gram_at], np.concatenate(([0], np.cumsum(sizes))), span, words.first)
        x = self.inputs(part)
        raw, (window, tapes, h, look, weight, pool) = self.forward(x, span, offset, keep=True)
        d_raw = ((_sigmoid(raw) - y) * weigh / len(y)).astype(np.float32)
        g = {"out": pool.T @ d_raw, "offset": d_raw.sum(keepdims=True)}
        d_pool = d_raw[:, None] * p["out"]
        d_h = weight[:, :, None] * d_pool[:, None]
        d_weight = (h @ d_pool[:, :, None])[:, :, 0]
        d_score = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
        g["query"] = np.einsum("nl,nlk->k", d_score, look)
        d_look = d_score[:, :, None] * p["query"] * (1 - look * look)
        g["look"] = h.reshape(-1, 2 * HIDDEN).T @ d_look.reshape(-1, HIDDEN)
        d_h += d_look @ p["look"].T
        d_x = np.zeros_like(x)
        for k, name in enumerate(LAYERS):
            weights, state_weights, _ = _gates(name, p)
            d_core = np.zeros((len(span), 2 * SEGMENT, HIDDEN), np.float32)
            d_core[window] = d_h[:, :, k * HIDDEN: (k + 1) * HIDDEN]
            rows = _both(span, name)
            d_states = np.zeros((*rows.shape, HIDDEN), np.float32)
            d_states[CORE[name]] = d_core.reshape(-1, SEGMENT, HIDDEN).transpose(1, 0, 2)
            d_in, g[f"{name}_state"] = _back(tapes[k], rows >= 0, state_weights, d_states)
            flat, where = d_in[rows >= 0], rows[rows >= 0]
            share = np.stack([np.bincount(where, flat[:, c], len(x)) for c in range(3 * HIDDEN)], 1)
            g[f"{name}_in"], g[f"{name}_bias"] = x.T @ share, share.sum(0)
            d_x += share @ weights.T
        g["words"] = np.zeros_like(p["words"])
        np.add.at(g["words"], self.places(part.keys), d_x[:, :WORD_SIZE])
        g["words"][0] = 0
        per_gram = np.repeat(d_x[:, WORD_SIZE: WORD_SIZE + CHAR_SIZE] / np.maximum(sizes, 1)[:, None], sizes, axis=0)
        g["chars"] = np.stack([np.bincount(part.grams, per_gram[:, c], CHAR_BUCKETS) for c in range(CHAR_SIZE)], 1)
        return g

    def highest(self, words: Words, stride: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(raw score of every window, each text's highest score or minus infinity)."""
        start, owner = words.windows(stride)
        best = np.full(len(words.first) - 1, -np.inf)
        if not len(start):
            return np.zeros(0), best
        h = self.states(words)
        weight = np.exp((_tanh(h @ self.p["look"]) @ self.p["query"]).astype(np.float64))
        # A pool's score is the mean of its states' scores.
        sums = words.window_sums(weight * (h @ self.p["out"]), start, owner)
        raw = sums / words.window_sums(weight, start, owner) + self.p["offset"][0]
        np.maximum.at(best, owner, raw)
        return raw, best

    def score(self, texts: tokens.Texts) -> np.ndarray:
        best = self.highest(Words.of(texts))[1]
        return np.where(np.isfinite(best), learn.sigmoid(self.slope * np.where(np.isfinite(best), best, 0) + self.shift), 0.0)


def tell(in_toxic: np.ndarray, in_all: np.ndarray, share: float) -> np.ndarray:
    """How surely each word tells toxic from clean texts: the root of its likelihood ratio beyond what chance gives many words."""
    rate = np.clip(in_toxic / np.maximum(in_all, 1), 1e-9, 1 - 1e-9)
    ratio = 2 * (in_toxic * np.log(rate / share) + (in_all - in_toxic) * np.log((1 - rate) / (1 - share)))
    root = np.sign(rate - share) * np.sqrt(np.maximum(ratio, 0))
    return np.clip(np.sign(root) * np.maximum(np.abs(root) - BY_CHANCE, 0) / 2, -2, 3).astype(np.float32)


def _tally(owner: np.ndarray, keys: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, toxic texts with each, texts with each)"""
    unique, which = np.unique(keys, return_inverse=True)
    text_of, key_of = np.divmod(np.unique(owner * max(1, len(unique)) + which), max(1, len(unique)))
    return unique, np.bincount(key_of, toxic[text_of], len(unique)), np.bincount(key_of, minlength=len(unique))


def stems_telling(of_words: np.ndarray, stems: np.ndarray, stems_tell: np.ndarray) -> np.ndarray:
    """The most that any beginning of each word tells, 0 if none tells anything."""
    out = np.zeros(len(of_words), np.float32)
    if len(stems):
        for column in of_words.T:
            at = np.minimum(np.searchsorted(stems, column), len(stems) - 1)
            out = np.maximum(out, np.where(stems[at] == column, stems_tell[at], 0))
    return out


def mixed_up(span: np.ndarray, offset: np.ndarray, label: np.ndarray, random: np.random.Generator) -> None:
    """Put words of clean windows' surroundings around some windows, and behind their text's end: that changes no label, so
    the network learns that it doesn't matter where in a text a window lies."""
    clean, size = np.flatnonzero(label == 0), span.shape[1]
    if len(clean):
        place = np.arange(size)
        other = span[random.choice(clean, len(span))]
        other = np.take_along_axis(other, (place + random.integers(size, size=(len(span), 1))) % size, 1)
        behind = place - LEAD - offset[:, None]
        own = (behind >= 0) & (behind < WINDOW) & (span >= 0)
        some = (random.random(len(span)) < MIXED)[:, None] & ~own
        span[some] = other[some]


def fit(texts: list[str], y: np.ndarray) -> Network | None:
    if not len(y) or y.min() == y.max():
        return None
    words = Words.of(tokens.texts_of(pa.array(texts, pa.large_string())))
    if not len(words.which):
        return None
    toxic = y > 0.5
    owner = tokens.owners(words.first)
    _, in_toxic, in_all = _tally(owner, words.keys[words.which], toxic)
    telling = tell(in_toxic, in_all, toxic.mean())
    common = in_all >= LEAST_TEXTS
    of_stems = words.stems[words.which]
    some = of_stems != 0
    stems, in_toxic, in_all = _tally(np.broadcast_to(owner[:, None], of_stems.shape)[some], of_stems[some], toxic)
    stems_tell = tell(in_toxic, in_all, toxic.mean())
    known = stems_tell > 0
    network = Network.fresh(words.keys[common], telling[common], stems[known], stems_tell[known])
    for_clean = telling < 0
    telling = np.maximum(telling, stems_telling(words.stems, stems[known], stems_tell[known]))

    start, of_text = words.windows()
    rows = words.rows(start, of_text, range(WINDOW))
    # Before the first round a window scores what its most telling word does.
    raw = np.where(rows >= 0, telling[rows], -9).max(1)
    random = np.random.default_rng(11)
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    step = 0
    for _ in range(ROUNDS):
        rank = np.lexsort((-raw, of_text))
        place = np.arange(len(rank)) - np.searchsorted(of_text[rank], of_text[rank])
        chosen = rank[np.where(toxic[of_text[rank]], place < 1, place < CLEAN_WINDOWS // 2)]
        others = np.flatnonzero(~toxic[of_text])
        chosen = np.unique(np.concatenate((chosen, random.choice(others, min(len(others), CLEAN_WINDOWS // 2 * (~toxic).sum()), replace=False))))
        span, offset = words.around(start[chosen], of_text[chosen])
        label = toxic[of_text[chosen]].astype(np.float32)
        mixed_up(span, offset, label, random)
        # A clean window stays clean without the words that speak for it, so that their lack tells nothing.
        bare = (label == 0) & (random.random(len(chosen)) < BARE)
        span[bare[:, None] & (span >= 0) & for_clean[span]] = -1
        weigh = np.where(label > 0, len(label) / (2 * max(1, label.sum())), len(label) / (2 * max(1, (1 - label).sum())))
        for _ in range(max(EPOCHS, -(-LEAST_STEPS // -(-len(chosen) // BATCH)))):
            order = random.permutation(len(chosen))
            for k in range(0, len(order), BATCH):
                some = order[k: k + BATCH]
                step += 1
                for name, g in network.gradients(words, span[some], offset[some], label[some], weigh[some]).items():
                    m, v = state[name]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    # Vectors of single words learn slowly: there are more of them than labelled texts.
                    rate = 0.0005 if name in ("words", "chars") else 0.01
                    network.p[name] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        raw = network.highest(words, STRIDE)[0]
    best = network.highest(words)[1]
    found = np.isfinite(best)
    network.slope, network.shift = learn.calibrate(best[found], y[found])
    return network


def train(docs: DataFrame, labels: DataFrame, *, folds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> Network | None:
    rows = []
    for value, most in ((1, TOXIC_ROWS), (0, CLEAN_ROWS)):
        chosen = labelled.sample(docs, labels.where(F.col("toxic") == value), "toxic", rows=most, folds=folds, id_col=id_col, text_col=text_col)
        # At most `most` texts of at most `TRAIN_BYTES`.
        rows += chosen.where(F.octet_length("text") <= TRAIN_BYTES).collect()
    rows.sort(key=lambda r: (str(r.id), r.text))
    return fit([r.text for r in rows], np.array([r.label for r in rows]))


def score(docs: DataFrame, network: Network | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, score (0 to 1), predicted (1 from `PREDICT_AT`)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in tokens.chunks(batch.column(1)):
                got = network.score(texts) if network else np.zeros(b - a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(got, pa.float64()), pa.array((got >= PREDICT_AT).astype(np.int32))],
                    names=["id", "score", "predicted"],
                )

    key = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {key}, score double, predicted int")
    return out.withColumnRenamed("id", id_col)

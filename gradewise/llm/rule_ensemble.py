"""Quality classifier as a sparse rule ensemble.

Boosted regression trees over a text's statistics give the rules: every path from a root is a conjunction of
comparisons. A logistic regression with an L1 penalty picks and weighs a few of them, and those are compiled into one Spark
column expression over the statistics. Trees and weights are fitted on at most `labels.SAMPLE_ROWS` labelled rows, whose statistics
(a few numbers each) the driver gets. Statistics are computed in Arrow batches; nothing is shuffled.

Defined results: a null or empty text has statistics of 0 and the score that the rules give those; without labels of both kinds
there are no rules and every score is the share of good labels (0.5 without any); repeated rows score alike; labels and other
columns than the text are never read when scoring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewise.llm import labels as labelled
from gradewise.llm import learn, quality_rules, tokens

TREES = 40
DEPTH = 3
BINS = 24
LEAST_ROWS = 10
PENALTY = 0.001
PREDICT_AT = 0.3

IS_DIGIT = np.zeros(256, bool)
IS_DIGIT[0x30:0x3A] = True
IS_UPPER = np.zeros(256, bool)
IS_UPPER[0x41:0x5B] = True
IS_PUNCT = np.zeros(256, bool)
IS_PUNCT[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True

STATISTICS = (
    "words", "word_length", "symbols", "digits", "capitals", "punctuation", "distinct_words", "echoed_words",
    "repeated_windows", "repeated_lines", "words_per_line", "bare_symbols",
)


def statistics(texts: tokens.Texts) -> dict[str, np.ndarray]:
    """Of each text: log of the number of words, and shares of its words, characters or lines."""
    c = quality_rules.counts(texts)
    starts, ends, first = texts.spans(tokens.IS_WORD)
    hashes = texts.hashes(starts, ends, tokens.LOWER_CODES)
    owner = tokens.owners(first)
    n = np.maximum(c["n_words"], 1)
    chars = np.maximum(c["word_chars"], 1)
    _, later = tokens.repeated(tokens.mix(hashes ^ (owner.astype(np.uint64) * tokens.BASE)))
    echo = np.zeros(len(hashes), bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    bare = np.zeros(len(hashes), bool)
    if len(starts):
        # Words of symbols alone.
        others = np.concatenate(([0], np.cumsum(~IS_PUNCT[texts.data])))
        bare = others[starts] == others[ends]
    lines = texts.counted(np.flatnonzero(texts.data == quality_rules.NEWLINE)) + 1

    def share(member: np.ndarray) -> np.ndarray:
        return texts.counted(np.flatnonzero(member[texts.data])) / chars

    def of_words(flag: np.ndarray) -> np.ndarray:
        return np.bincount(owner[flag], minlength=len(texts)) / n

    return {
        "words": np.log1p(c["n_words"]), "word_length": c["word_chars"] / n, "symbols": c["n_symbols"] / chars,
        "digits": share(IS_DIGIT), "capitals": share(IS_UPPER), "punctuation": share(IS_PUNCT),
        "distinct_words": (c["n_words"] - np.bincount(owner[later], minlength=len(texts))) / n,
        "echoed_words": of_words(echo), "repeated_windows": c["n_repeat_words"] / n,
        "repeated_lines": c["n_dup_lines"] / lines, "words_per_line": np.log1p(c["n_words"] / lines), "bare_symbols": of_words(bare),
    }


# One comparison of a rule: (statistic, threshold, whether it is above).
Test = tuple[int, float, bool]


def _paths(bins: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, cuts: list[np.ndarray], path: tuple[Test, ...] = ()) -> list[tuple]:
    """(path, value) of every node but the root of one regression tree, depth first; `bins` counts the cuts below each value."""
    def gain(g, h):
        return g * g / (h + 1.0)

    g, h = gradient.sum(), hessian.sum()
    best = (1e-6, -1, 0)
    for j, thresholds in enumerate(cuts):
        k = len(thresholds)
        if not k:
            continue
        # Sums of the rows above each cut.
        n, g_up, h_up = (np.bincount(bins[:, j], w, k + 1)[::-1].cumsum()[::-1][1:] for w in (None, gradient, hessian))
        won = gain(g_up, h_up) + gain(g - g_up, h - h_up) - gain(g, h)
        won[(n < LEAST_ROWS) | (len(bins) - n < LEAST_ROWS)] = 0
        if won.max() > best[0]:
            best = (won.max(), j, int(won.argmax()))
    out = []
    _, j, k = best
    for up in (False, True) if j >= 0 else ():
        rows = (bins[:, j] > k) == up
        here = (*path, (j, float(cuts[j][k]), up))
        out.append((here, gradient[rows].sum() / (hessian[rows].sum() + 1.0)))
        if len(here) < DEPTH:
            out += _paths(bins[rows], gradient[rows], hessian[rows], cuts, here)
    return out


def holds(x: np.ndarray, path: tuple[Test, ...]) -> np.ndarray:
    return reduce(and_, ((x[:, j] > t) == up for j, t, up in path))


@dataclass
class Ensemble:
    """sigmoid(bias + the weights of the rules that hold) is the score."""

    bias: float
    rules: list[tuple[float, tuple[Test, ...]]]

    def predict(self, x: np.ndarray) -> np.ndarray:
        return learn.sigmoid(self.bias + sum((w * holds(x, p) for w, p in self.rules), np.zeros(len(x))))

    def column(self) -> Column:
        """The score as an expression over columns named like `STATISTICS`."""
        raw = F.lit(self.bias)
        for weight, path in self.rules:
            tests = ((F.col(STATISTICS[j]) > t) if up else (F.col(STATISTICS[j]) <= t) for j, t, up in path)
            raw = raw + F.when(reduce(and_, tests), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-raw))


def fit(x: np.ndarray, y: np.ndarray) -> Ensemble:
    share = float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
    prior = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Ensemble(prior, [])
    cuts = []
    for j in range(x.shape[1]):
        values = np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, BINS)))
        cuts.append(np.unique(np.round(values, 6)))
    bins = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
    raw = np.full(len(y), prior)
    rules: dict[tuple[Test, ...], None] = {}
    for tree in range(TREES):
        p = learn.sigmoid(raw)
        # Each tree sees half of the rows, so that the trees differ.
        some = np.random.default_rng(tree).random(len(y)) < 0.5
        nodes = _paths(bins[some], (y - p)[some], (p * (1 - p))[some], cuts)
        inner = {n[:-1] for n, _ in nodes}
        for path, value in nodes:
            rules[tuple(sorted(path))] = None
            if path not in inner:
                raw += 0.3 * value * holds(x, path)
    paths = list(rules)
    hits = np.column_stack([holds(x, p) for p in paths]).astype(float) if paths else np.zeros((len(y), 0))
    weights, bias = _lasso(hits, y, prior)
    return Ensemble(bias, [(float(w), p) for w, p in zip(weights, paths) if abs(w) > 1e-4])


def _lasso(x: np.ndarray, y: np.ndarray, bias: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """L1-penalised logistic regression by accelerated proximal gradient; the bias isn't penalised."""
    x = np.column_stack((x, np.ones(len(y))))
    rate = 4 * len(y) / max(np.linalg.norm(x, 2) ** 2, 1e-9)
    w = np.append(np.zeros(x.shape[1] - 1), bias)
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        new = ahead - rate * (x.T @ (learn.sigmoid(x @ ahead) - y)) / len(y)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * PENALTY, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w[:-1], float(w[-1])


def measure(docs: DataFrame, carried: list[str], *, text_col: str = "text") -> DataFrame:
    """The `carried` columns and the statistics of each text."""
    clash = set(carried) & set(STATISTICS)
    if clash:
        raise ValueError(f"rename these columns: {sorted(clash)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in tokens.chunks(batch.column(len(carried))):
                got = statistics(texts)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in range(len(carried))), *(pa.array(got[s], pa.float64()) for s in STATISTICS)],
                    names=[*carried, *STATISTICS],
                )

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    return docs.select(*carried, F.col(text_col).alias("__text")).mapInArrow(run, kept + "".join(f", {s} double" for s in STATISTICS))


def train(docs: DataFrame, labels: DataFrame, *, rows: int = labelled.SAMPLE_ROWS, folds: int = 5,
          id_col: str = "doc_id", text_col: str = "text") -> Ensemble:
    chosen = labelled.sample(docs, labels, "quality", rows=rows, folds=folds, id_col=id_col, text_col=text_col)
    got = measure(chosen, ["id", "label"]).collect()
    got.sort(key=lambda r: tuple(map(str, r)))
    x = np.array([[r[s] for s in STATISTICS] for r in got]).reshape(-1, len(STATISTICS))
    return fit(x, np.array([r.label for r in got]))


def score(docs: DataFrame, ensemble: Ensemble, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, score (0 to 1), predicted (1 from `PREDICT_AT`), then the statistics, but for one of the id's name."""
    named = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    scored = measure(named, ["__id"]).withColumn("score", ensemble.column())
    return scored.select(
        F.col("__id").alias(id_col), "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"), *(s for s in STATISTICS if s != id_col),
    )

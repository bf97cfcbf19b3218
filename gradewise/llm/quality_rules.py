"""Quality rules: fixed counts per text, and a hashed n-gram logistic regression with calibrated probabilities.

The model sees hashed word n-grams (one and two words, A-Z lower-cased) and hashed character n-grams (of three
and four UTF-8 bytes), each family as relative frequencies. It is trained on at most `labels.SAMPLE_ROWS`
labelled rows, three quarters of them for the weights and one for the calibration, and scores whole texts
in Arrow batches against `KEEP_AT`. No shuffle; a task holds one chunk of texts and the weights.

Defined results: a null or empty text has no words, fails the base rules and gets the probability of no
evidence; without labels of both kinds the model answers 0.5, above the threshold, so that the base rules
alone decide; repeated rows are scored alike; other columns pass through `keep` and don't matter elsewhere.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gradewise.llm import labels as labelled
from gradewise.llm import learn, tokens

BITS = 15
KEEP_AT = 0.2
LEAST_WORDS = 20
REPEAT_PERCENT = 30
REPEAT_WINDOW = 8

# Fixed value: the characters counted as symbols.
SYMBOLS = "[#*$%&|<>]"

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True
LEADS = np.ones(256, bool)
LEADS[0x80:0xC0] = False  # the bytes inside a character
NEWLINE = 0x0A

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def counts(texts: tokens.Texts) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    starts, ends, first = texts.spans(tokens.IS_WORD)
    n_words = np.diff(first)
    in_words = tokens.IS_WORD[texts.data] & LEADS[texts.data]
    hashes = texts.hashes(starts, ends)
    owner = tokens.owners(first)

    window, at = tokens.windows(hashes, first, REPEAT_WINDOW)
    n_repeat = np.zeros(len(texts), np.int64)
    if len(at):
        shared, _ = tokens.repeated(tokens.mix(window ^ (owner[at].astype(np.uint64) * tokens.BASE)))
        cover = np.zeros(len(hashes) + 1, np.int64)
        cover[at[shared]] += 1
        np.subtract.at(cover, at[shared] + REPEAT_WINDOW, 1)
        n_repeat = np.bincount(owner[np.cumsum(cover)[:-1] > 0], minlength=len(texts))

    breaks = np.flatnonzero(texts.data == NEWLINE)
    # A line starts at each text's start and behind each break.
    line_starts = np.sort(np.concatenate((texts.bounds[:-1], breaks + 1)), kind="stable")
    line_owner = np.repeat(np.arange(len(texts)), texts.counted(breaks) + 1)
    line_ends = np.concatenate((line_starts[1:], [len(texts.data)])) if len(line_starts) else line_starts
    line_ends = np.where(np.append(line_owner[1:] == line_owner[:-1], False), line_ends - 1, texts.bounds[1:][line_owner])
    wordy = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    lines, whose = texts.hashes(line_starts[wordy], line_ends[wordy]), line_owner[wordy]
    _, later = tokens.repeated(tokens.mix(lines ^ (whose.astype(np.uint64) * tokens.BASE)))
    return {
        "n_words": n_words, "word_chars": texts.counted(np.flatnonzero(in_words)),
        "n_symbols": texts.counted(np.flatnonzero(IS_SYMBOL[texts.data])),
        "n_dup_lines": np.bincount(whose[later], minlength=len(texts)), "n_repeat_words": n_repeat,
    }


def base_failed(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > REPEAT_PERCENT * c["n_words"])


def families(texts: tokens.Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, number of features before each text) of each family of n-grams."""
    shift = np.uint64(64 - BITS)
    starts, ends, first = texts.spans(tokens.IS_WORD)
    words = texts.hashes(starts, ends, tokens.LOWER_CODES)
    yield (words >> shift).astype(np.int32), first
    pairs, at = tokens.windows(words, first, 2)
    yield (pairs >> shift).astype(np.int32), np.searchsorted(at, first)
    data = texts.data.astype(np.uint32)
    small = np.uint32(32 - BITS)
    for size, factor in ((3, 0x9E3779B1), (4, 0x85EBCA6B)):
        n = max(0, len(data) - size + 1)
        gram = np.zeros(n, np.uint32)
        for k in range(size):
            gram = (gram << np.uint32(8)) | data[k: k + n]
        gram = (gram * np.uint32(factor)) >> small
        # The grams that begin in a text and end in the next aren't its own.
        last = np.maximum(texts.bounds[1:] - size + 1, texts.bounds[:-1])
        inside = np.zeros(n + 1, np.int8)
        np.add.at(inside, np.minimum(texts.bounds[:-1], n), 1)
        np.add.at(inside, np.minimum(last, n), -1)
        keep = np.flatnonzero(np.cumsum(inside[:n]) > 0)
        yield gram[keep].astype(np.int32), np.searchsorted(keep, texts.bounds)


FAMILIES = 4


@dataclass
class Model:
    """A weight per family and feature; sigmoid(slope * raw + shift) is the probability of good quality."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, texts: tokens.Texts) -> np.ndarray:
        raw = np.full(len(texts), self.bias)
        for family, (index, first) in enumerate(families(texts)):
            sums = np.concatenate(([0.0], np.cumsum(self.weights[family][index], dtype=np.float64)))
            n = np.diff(first)
            raw += (sums[first[1:]] - sums[first[:-1]]) / np.maximum(n, 1)
        return learn.sigmoid(self.slope * raw + self.shift)


def features(texts: tokens.Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the features (family * 2^BITS + bucket) and their relative frequencies."""
    out: list[list[tuple]] = [[] for _ in range(len(texts))]
    for family, (index, first) in enumerate(families(texts)):
        for i in range(len(texts)):
            found, n = np.unique(index[first[i]: first[i + 1]], return_counts=True)
            out[i].append((found + (family << BITS), (n / max(1, n.sum())).astype(np.float32)))
    return [tuple(map(np.concatenate, zip(*parts))) for parts in out]


def _packed(values: np.ndarray) -> bytes:
    """Bytes, packed without loss: steps between features and frequencies are mostly the same few numbers."""
    return zlib.compress(values.tobytes(), 1)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, texts in tokens.chunks(batch.column(1)):
            got = features(texts)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                pa.array([_packed(np.diff(x, prepend=0).astype(np.int32)) for x, _ in got], pa.binary()),
                pa.array([_packed(v) for _, v in got], pa.binary()),
            ], names=["id", "label", "features", "values"])


def train(
    docs: DataFrame, labels: DataFrame, *, rows: int = labelled.SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text",
) -> Model:
    """Fit on the sample's features, which have at most FAMILIES * 2^BITS entries a row whatever its text's length."""
    chosen = labelled.sample(docs, labels, "quality", rows=rows, id_col=id_col, text_col=text_col)
    key = chosen.schema["id"].dataType.simpleString()
    got = chosen.mapInArrow(_feature_rows, f"id {key}, label double, features binary, values binary").collect()
    got.sort(key=lambda r: (str(r.id), bytes(r.features)))
    return fit(
        [np.cumsum(_unpacked(r.features, np.int32), dtype=np.int32) for r in got], [_unpacked(r["values"], np.float32) for r in got],
        np.array([r.label for r in got]),
    )


def fit(index: list[np.ndarray], values: list[np.ndarray], y: np.ndarray) -> Model:
    width = FAMILIES << BITS
    if not len(y) or (y > 0.5).all() or (y <= 0.5).all():
        return Model(np.zeros((FAMILIES, 1 << BITS), np.float32), 0.0, 1.0, 0.0)
    rows = np.arange(len(y))
    for_fit, for_scale = rows[rows % 4 != 3], rows[rows % 4 == 3]
    some = lambda of: learn.Sparse.of([index[i] for i in of], [values[i] for i in of], width)
    weights, bias = learn.fit_logistic(some(for_fit), y[for_fit])
    slope, shift = learn.calibrate(some(for_scale).dot(weights) + bias, y[for_scale])
    return Model(weights.reshape(FAMILIES, -1).astype(np.float32), float(bias), slope, shift)


def judged(texts: tokens.Texts, model: Model) -> dict[str, np.ndarray]:
    c = counts(texts)
    failed = base_failed(c)
    p = model.probability(texts)
    return c | {"base_failed": failed, "probability": p, "kept": ~failed & (p >= KEEP_AT)}


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, the base counts, base_failed, probability, kept."""
    names = [*COUNTS, "base_failed", "probability", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in tokens.chunks(batch.column(1)):
                got = judged(texts, model)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *(pa.array(got[n]) for n in names)], names=["id", *names],
                )

    key = docs.schema[id_col].dataType.simpleString()
    columns = ", ".join(f"{n} long" for n in COUNTS)
    out = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(
        run, f"id {key}, {columns}, base_failed boolean, probability double, kept boolean",
    )
    return out.withColumnRenamed("id", id_col)


def keep(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for a, b, texts in tokens.chunks(batch.column(at)):
                yield batch.slice(a, b - a).filter(pa.array(judged(texts, model)["kept"]))

    return docs.mapInArrow(run, docs.schema)

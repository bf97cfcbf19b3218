"""Interpolated modified Kneser-Ney model of word pairs, counted in Spark and read through memory maps.

Tokens are words (A-Z lower-cased) and one end for each text; the first token follows a start that is no token
itself. Training has three passes of bounded tasks:

1. A profile: tokens, and the words frequent enough to need splitting.
2. Pairs: each task counts its pairs and ships, for each bucket, the distinct ones. A pair's bucket follows from its
   first word, for a frequent first word from both, so that no word fills a bucket. A bucket's task merges the
   counts, stores them as a file of sorted 64-bit hashes with a count each, and ships what it knows of each word.
3. Words: buckets of words are merged and stored likewise: count, distinct followers by count, distinct predecessors.

A worker that scores maps those files into memory and looks up the distinct words and pairs of a chunk of texts, sorted, by
binary search. Only figures of a bucket each reach the driver. Files lie in the shared scratch folder under names of the task's own, and
only what finished tasks report is used. The folder must be mounted where the workers run for memory maps; from a store
without a mount a worker reads one file at a time into memory.

Defined results: a null or empty text is the end alone; a null id trains and isn't held out; without training tokens every
token has the same chance; repeated rows count each; other columns don't matter.
"""

from __future__ import annotations

import math
import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewise.llm import tokens
from gradewise.llm.tables import stored
from gradewise.session import scratch_path

FLUSH_TOKENS = 1_200_000
BUCKET_TOKENS = 1_000_000
# A word is split over buckets if it makes up more than one in FREQUENT tokens; so at most that many are.
FREQUENT = 2000
CHUNK_BYTES = 2 << 20

START = tokens.mixed_int(1)
END = tokens.mixed_int(2)


def sequences(texts: tokens.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(predecessor of each token, token, tokens before each text), every text closed by an end."""
    starts, ends, first = texts.spans(tokens.IS_WORD)
    words = texts.hashes(starts, ends, tokens.LOWER_CODES)
    begin = first + np.arange(len(first))
    token = np.full(begin[-1], END, np.uint64)
    token[np.arange(len(words)) + tokens.owners(first)] = words
    before = np.concatenate((token[:1], token[:-1]))
    before[begin[:-1]] = START
    return before, token, begin


def pair_key(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return tokens.mix(before * tokens.BASE + token)


def _bucket(before: np.ndarray, token: np.ndarray, frequent: np.ndarray, buckets: int) -> np.ndarray:
    split = np.isin(before, frequent)
    return (tokens.mix(np.where(split, before ^ token, before)) % np.uint64(buckets)).astype(np.int32)


def _word_bucket(words: np.ndarray, buckets: int) -> np.ndarray:
    return (tokens.mix(words ^ END) % np.uint64(buckets)).astype(np.int32)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Predecessors and tokens of about `FLUSH_TOKENS` tokens at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for batch in batches:
        for _, _, texts in tokens.chunks(batch.column(0)):
            before, token, _ = sequences(texts)
            held.append((before, token))
            n += len(token)
            if n >= FLUSH_TOKENS:
                yield tuple(map(np.concatenate, zip(*held)))
                held, n = [], 0
    if n:
        yield tuple(map(np.concatenate, zip(*held)))


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, token in _held(batches):
        words, counts = np.unique(token, return_counts=True)
        many = counts * FREQUENT > len(token)
        word = np.append(words[many], np.uint64(0)).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(word), pa.array(np.append(counts[many], 0), pa.int64()),
             pa.array(np.append(np.zeros(many.sum(), np.int64), len(token)))], names=["word", "n", "total"],
        )


PAIRS = "bucket int, heads binary, runs binary, tails binary, counts binary"


def _pairs(frequent: np.ndarray, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for before, token in _held(batches):
            _, at, counts = np.unique(pair_key(before, token), return_index=True, return_counts=True)
            u, w = before[at], token[at]
            bucket = _bucket(u, w, frequent, buckets)
            order = np.lexsort((w, u, bucket))
            u, w, bucket, counts = u[order], w[order], bucket[order], counts[order].astype(np.uint32)
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            rows = []
            for k in np.flatnonzero(np.diff(edges)):
                part = slice(edges[k], edges[k + 1])
                heads, first = np.unique(u[part], return_index=True)
                runs = np.diff(np.append(first, len(u[part]))).astype(np.uint32)
                rows.append({
                    "bucket": int(k), "heads": heads.tobytes(), "runs": runs.tobytes(),
                    "tails": w[part].tobytes(), "counts": counts[part].tobytes(),
                })
                if len(rows) == 64:
                    yield pa.RecordBatch.from_pylist(rows, schema=_PAIRS)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_PAIRS)

    return run


_PAIRS = pa.schema([("bucket", pa.int32()), *((n, pa.binary()) for n in ("heads", "runs", "tails", "counts"))])


def _joined(table: pa.Table, column: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of each value."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    return ordered[first], *(np.add.reduceat(v[order], first) for v in values)


def _store(path: str, kind: str, *arrays: np.ndarray) -> str:
    name = f"{kind}-{uuid.uuid4().hex}"
    files, root = _files(path)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(posixpath.join(root, name), compression=None) as out:
        for array in arrays:
            out.write(np.ascontiguousarray(array).tobytes())
    return name


def _files(path: str):
    return pa.fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))


# What a bucket of pairs, or of words, reports: `numbers` are counts of counts of 1, 2, 3 and 4, then totals.
REPORT = "kind string, bucket int, name string, n long, numbers array<long>, words binary, counts binary, ones binary, twos binary, more binary, befores binary"
_REPORT = pa.schema([
    ("kind", pa.string()), ("bucket", pa.int32()), ("name", pa.string()), ("n", pa.int64()), ("numbers", pa.list_(pa.int64())),
    *((n, pa.binary()) for n in ("words", "counts", "ones", "twos", "more", "befores")),
])
FIGURES = ("counts", "ones", "twos", "more", "befores")


def _tallied(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _merge_pairs(path: str, word_buckets: int):
    def run(table: pa.Table) -> pa.Table:
        u = np.repeat(_joined(table, "heads", np.uint64), _joined(table, "runs", np.uint32))
        w, counts = _joined(table, "tails", np.uint64), _joined(table, "counts", np.uint32)
        keys = pair_key(u, w)
        order = np.argsort(keys, kind="stable")
        keys, u, w = keys[order], u[order], w[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        counts = np.add.reduceat(counts[order].astype(np.int64), first)
        keys, u, w = keys[first], u[first], w[first]
        name = _store(path, "pairs", keys, np.minimum(counts, 0xFFFFFFFF).astype(np.uint32))
        rows = [{
            "kind": "pairs", "bucket": table.column("bucket")[0].as_py(), "name": name, "n": len(keys), "numbers": _tallied(counts),
        }]
        context = _summed(u, counts, *((counts == k).astype(np.int64) for k in (1, 2)), (counts > 2).astype(np.int64))
        zeros = np.zeros(len(context[0]), np.int64)
        follow = _summed(w, np.ones(len(w), np.int64))
        for words, values in ((context[0], (*context[1:], zeros)), (follow[0], (None, None, None, None, follow[1]))):
            bucket = _word_bucket(words, word_buckets)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(word_buckets + 1))
            for k in np.flatnonzero(np.diff(edges)):
                part = order[edges[k]: edges[k + 1]]
                empty = np.zeros(len(part), np.uint32)
                rows.append({"kind": "words", "bucket": int(k), "words": words[part].tobytes()} | {
                    f: (empty if v is None else v[part].astype(np.uint32)).tobytes() for f, v in zip(FIGURES, values)
                })
        return pa.Table.from_pylist(rows, schema=_REPORT)

    return run


def _merge_words(path: str):
    def run(table: pa.Table) -> pa.Table:
        words, *figures = _summed(
            _joined(table, "words", np.uint64), *(_joined(table, f, np.uint32).astype(np.int64) for f in FIGURES),
        )
        befores = figures[-1]
        name = _store(path, "words", words, *(np.minimum(f, 0xFFFFFFFF).astype(np.uint32) for f in figures))
        counted = figures[0][(words != START) & (words != END)].sum() + figures[0][words == START].sum()
        numbers = [*_tallied(befores), int(befores.sum()), int((befores > 0).sum()), int(counted)]
        return pa.Table.from_pylist([{
            "kind": "words", "bucket": table.column("bucket")[0].as_py(), "name": name, "n": len(words), "numbers": numbers,
        }], schema=_REPORT)

    return run


def discounts(n: list[int]) -> tuple[float, float, float]:
    """What is taken off counts of 1, 2 and 3 or more, from how many counts are 1, 2, 3 and 4."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    raw = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * 0.5 for k in (1, 2, 3)]
    return tuple(min(max(d, 0.05 * k), 0.95 * k) for k, d in zip((1, 2, 3), raw))


@dataclass
class Model:
    path: str
    frequent: np.ndarray
    buckets: int
    word_buckets: int
    pair_files: dict[int, tuple[str, int]]
    word_files: dict[int, tuple[str, int]]
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    tallies: tuple[int, int, int]  # words with one, two, and more predecessors
    types: int  # distinct pairs
    vocabulary: int
    train_tokens: int
    _maps: dict = field(default_factory=dict, repr=False)

    def _columns(self, kind: str, bucket: int) -> list[np.ndarray] | None:
        names = self.pair_files if kind == "pairs" else self.word_files
        if bucket not in names:
            return None
        name, n = names[bucket]
        if name not in self._maps:
            files, root = _files(self.path)
            if isinstance(files, pa.fs.LocalFileSystem):
                data = np.memmap(posixpath.join(root, name), np.uint8, "r")
                self._maps[name] = data
            else:
                with files.open_input_file(posixpath.join(root, name)) as f:
                    data = np.frombuffer(f.read(), np.uint8)
        else:
            data = self._maps[name]
        rest = (len(data) - 8 * n) // (4 * n)
        return [data[: 8 * n].view(np.uint64), *(data[8 * n + 4 * n * k: 8 * n + 4 * n * (k + 1)].view(np.uint32) for k in range(rest))]

    def _find(self, kind: str, keys: np.ndarray, bucket: np.ndarray, columns: int) -> np.ndarray:
        """The stored figures of each key, zeros if there are none."""
        out = np.zeros((columns, len(keys)), np.float64)
        order = np.lexsort((keys, bucket))
        present, edges = np.unique(bucket[order], return_index=True)
        for k, a, b in zip(present.tolist(), edges, [*edges[1:], len(keys)]):
            held = self._columns(kind, k)
            if held is None:
                continue
            mine = order[a:b]
            at = np.minimum(np.searchsorted(held[0], keys[mine]), len(held[0]) - 1)
            hit = held[0][at] == keys[mine]
            for c in range(columns):
                out[c, mine[hit]] = held[1 + c][at[hit]]
        return out

    def score(self, texts: tokens.Texts) -> dict[str, np.ndarray]:
        before, token, begin = sequences(texts)
        words, which = np.unique(np.concatenate((before, token)), return_inverse=True)
        of_before, of_token = which[: len(before)], which[len(before):]
        count, ones, twos, more, befores = self._find("words", words, _word_bucket(words, self.word_buckets), 5)
        seen = count.copy()
        seen[words == END] = self._find("words", np.array([START]), _word_bucket(np.array([START]), self.word_buckets), 5)[0]
        seen[words == START] = 0

        e, d = self.word_discounts, self.pair_discounts
        left = sum(x * t for x, t in zip(e, self.tallies)) / max(1, self.types)
        taken = np.select([befores == 0, befores == 1, befores == 2], [0.0, e[0], e[1]], e[2])
        alone = (befores - taken) / max(1, self.types) + (left if self.types else 1.0) / (self.vocabulary + 1)
        share = (d[0] * ones + d[1] * twos + d[2] * more) / np.maximum(count, 1)

        keys, first, pair = np.unique(pair_key(before, token), return_index=True, return_inverse=True)
        b, t = of_before[first], of_token[first]
        together = self._find("pairs", keys, _bucket(before[first], token[first], self.frequent, self.buckets), 1)[0]
        taken = np.select([together == 0, together == 1, together == 2], [0.0, d[0], d[1]], d[2])
        known = count[b] > 0
        chance = np.where(known, (together - taken) / np.maximum(count[b], 1) + share[b] * alone[t], alone[t])
        logs = np.log10(chance)[pair]
        base = np.log10((seen[of_token] + 1) / (self.train_tokens + self.vocabulary + 1))
        return {
            "n_tokens": np.diff(begin), "n_known": np.add.reduceat((seen[of_token] > 0).astype(np.int64), begin[:-1]),
            "base_score": np.add.reduceat(base, begin[:-1]), "score": np.add.reduceat(logs, begin[:-1]),
        }


def train(texts: DataFrame, *, text_col: str = "text") -> Model:
    """Count all of the texts and store the model in the shared scratch folder."""
    spark = texts.sparkSession
    path = scratch_path(spark, "pairs-model")
    texts = texts.select(F.col(text_col).alias("text"))
    profile = stored(
        texts.mapInArrow(_profile, "word long, n long, total long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total")),
        "profile",
    )
    total = profile.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    # At most FREQUENT words.
    many = profile.where(F.col("n") * FREQUENT > total).select("word").collect()
    frequent = np.array([r.word for r in many], np.int64).view(np.uint64)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / BUCKET_TOKENS))

    pairs = texts.mapInArrow(_pairs(frequent, buckets), PAIRS)
    merged = stored(pairs.groupBy("bucket").applyInArrow(_merge_pairs(path, buckets), REPORT), "reports")
    words = stored(
        merged.where("kind = 'words'").groupBy("bucket").applyInArrow(_merge_words(path), REPORT).select("bucket", "name", "n", "numbers"), "words",
    )
    # A row for each bucket.
    pair_rows = merged.where("kind = 'pairs'").select("bucket", "name", "n", "numbers").collect()
    word_rows = words.collect()
    of_pairs = [sum(r.numbers[k] for r in pair_rows) for k in range(4)]
    of_words = [sum(r.numbers[k] for r in word_rows) for k in range(7)]
    return Model(
        path=path, frequent=frequent, buckets=buckets, word_buckets=buckets,
        pair_files={r.bucket: (r.name, r.n) for r in pair_rows}, word_files={r.bucket: (r.name, r.n) for r in word_rows},
        pair_discounts=discounts(of_pairs), word_discounts=discounts(of_words[:4]),
        tallies=(of_words[0], of_words[1], of_words[5] - of_words[0] - of_words[1]),
        types=of_words[4], vocabulary=of_words[5], train_tokens=of_words[6],
    )


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in tokens.chunks(batch.column(1), CHUNK_BYTES):
                got = model.score(texts)
                perplexity = 10 ** (-got["score"] / got["n_tokens"])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(got["n_tokens"]), pa.array(got["n_known"]),
                    pa.array(np.full(b - a, model.train_tokens)), pa.array(got["base_score"]), pa.array(got["score"]), pa.array(perplexity),
                ], names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    key = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {key}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double",
    )
    return out.withColumnRenamed("id", id_col)

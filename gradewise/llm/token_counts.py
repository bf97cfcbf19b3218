"""Tokens of each text, counted once for each distinct pre-token.

A pre-token is a stretch of text that no piece of the vocabulary reaches out of, so the tokens of a text are the sum of
those of its pre-tokens. In a vocabulary whose pieces have their space marks in front, a run of spaces with what follows it up to the next
space is one; characters that no piece has (line breaks here) stand alone. The vocabulary is checked for it.

1. Each task counts the pre-tokens of its documents, some MB of texts (a chunk) at a time. It ships the chunk's distinct pre-tokens to their
   buckets, and the documents' frequencies as packed numbers.
2. The task of a bucket counts the pieces of each distinct pre-token once, and sends each chunk the numbers for its pre-tokens, in their order.
   The frequencies pass through, dealt over all tasks.
3. The numbers of a chunk's pre-tokens meet its frequencies, and the products are added up for each document. No list of ids of a document is ever made.

What moves is the distinct pre-tokens of each chunk, however many buckets there are; a frequent pre-token comes once from each chunk. A task holds the distinct pre-tokens
of one bucket, then one chunk.

Defined results: a null or empty text has no bytes and no tokens; null ids and repeated rows are counted row by row; strings of special tokens are plain text, as
the library takes them; other columns don't matter. The vocabulary file is a parameter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewise.llm import tokens
from gradewise.llm.packing import packed, planes, unpacked

VOCABULARY = "piece_bpe_32k.model"
CHUNK_BYTES = 10 << 20
CHUNK_ROWS = 1 << 16
# A text beyond this is split piece by piece, not into a list.
LONG_TEXT = 4 << 20
BUCKETS_PER_PARTITION = 4
MARK = "▁"
BREAKS = "\n\t\r"
BATCH_ROWS = 20_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """Pre-tokens of texts and the number of pieces of a pre-token."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        alone = [c for c in BREAKS if not any(c in name for name in names)]
        if any(MARK in name.lstrip(MARK) for name in names) or not alone:
            raise ValueError("a piece of the vocabulary reaches over a space, so texts can't be cut there")
        # The text that a space stands before must come out of the library's normalizer as it went in.
        if self.model.encode("a  ﬁ", out_type=str)[-1] != "ﬁ" or self.model.encode("  ") == self.model.encode(" "):
            raise ValueError("the vocabulary's normalizer changes texts")
        space, alone = f" {MARK}", "".join(alone)
        self.pattern = re.compile(f"[{space}]*[^{space}{alone}]+|[{space}]+|[{alone}]")
        # Behind a character that no piece has, a pre-token is cut as it is within a text.
        self.lead = alone[0]
        self.lead_pieces = len(self.model.encode(self.lead))

    def split(self, text: str) -> Counter:
        """How often each pre-token occurs; a text begins with a space mark of its own."""
        if not text:
            return Counter()
        if len(text) > LONG_TEXT:
            return Counter(m.group() for m in self.pattern.finditer(" " + text))
        return Counter(self.pattern.findall(" " + text))

    def sizes(self, words: list[str]) -> list[int]:
        coded = self.model.encode([self.lead + w for w in words], num_threads=1)
        return [len(ids) - self.lead_pieces for ids in coded]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Chunk:
    """Distinct pre-tokens of some documents in the order of their buckets, and the documents' frequencies of them."""

    def __init__(self, counted: list[Counter], buckets: int):
        found = list(chain.from_iterable(counted))
        words = list(dict.fromkeys(found))
        n = len(words)
        home = np.fromiter(map(zlib.crc32, map(str.encode, words)), np.uint32, n) % np.uint32(buckets)
        order = np.argsort(home.astype(np.uint16) if buckets < 1 << 16 else home, kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.words = [words[i] for i in order.tolist()]
        self.edges = np.searchsorted(home[order], np.arange(buckets + 1))
        number = dict(zip(words, place.tolist()))
        code = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
        row = np.repeat(np.arange(len(counted), dtype=np.uint16), [len(c) for c in counted])
        times = np.fromiter(chain.from_iterable(c.values() for c in counted), np.uint32, len(found))
        # A word's documents in their order.
        by_word = np.argsort(code, kind="stable")
        self.row, self.times = row[by_word], times[by_word]
        self.runs = np.bincount(code, minlength=n).astype(np.uint32)

    def frequencies(self) -> tuple[int, bytes]:
        often = np.flatnonzero(self.times >= 255)
        return packed(
            np.array([len(self.runs), len(self.row), len(often)], np.int64), self.times[often], self.runs, *planes(self.row),
            np.minimum(self.times, 255).astype(np.uint8),
        )

    def lists(self) -> Iterator[tuple[int, list[str]]]:
        for k in np.flatnonzero(np.diff(self.edges)).tolist():
            yield k, self.words[self.edges[k]: self.edges[k + 1]]


def frequencies(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(documents that have each word, the documents word by word, how often each has it), from a chunk's packed ones."""
    n, m, many = np.frombuffer(raw, np.int64, 3).tolist()
    at = 24
    often = np.frombuffer(raw, np.uint32, many, at)
    runs = np.frombuffer(raw, np.uint32, n, at := at + 4 * many)
    low = np.frombuffer(raw, np.uint8, m, at := at + 4 * n).astype(np.int64)
    high = np.frombuffer(raw, np.uint8, m, at := at + m).astype(np.int64)
    times = np.frombuffer(raw, np.uint8, m, at + m).astype(np.int64)
    times[times == 255] = often
    return runs, low | high << 8, times


PARTS = ["chunk", "bucket", "words", "ids", "sizes", "size", "data"]
WHOLE = -1  # the bucket of a chunk's frequencies


def _slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    for a, b, _ in tokens.chunks(column, limit):
        for start in range(a, b, CHUNK_ROWS):
            yield start, min(b, start + CHUNK_ROWS)


def _lists(values: pa.Array, sizes: list[int]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), values)


def _chunks(path: str, buckets: int, chunk_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = pieces(path)
        # A task's chunks are numbered, so the numbers are the same if the task is run again.
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for a, b in _slices(texts, chunk_bytes):
                column = texts.slice(a, b - a)
                chunk = Chunk([cut.split(t) for t in column.to_pylist()], buckets)
                ids, sizes = batch.column(0).slice(a, b - a), pc.binary_length(column).cast(pa.int64())
                size, data = chunk.frequencies()
                yield pa.RecordBatch.from_arrays([
                    pa.array([number]), pa.array([WHOLE], pa.int32()), _lists(pa.array([], pa.string()), [0]), _lists(ids, [b - a]), _lists(sizes, [b - a]),
                    pa.array([size], pa.int32()), pa.array([data], pa.binary()),
                ], names=PARTS)
                lists = list(chunk.lists())
                n = len(lists)
                if n:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(n, number)), pa.array([k for k, _ in lists], pa.int32()), _lists(pa.array(chunk.words, pa.string()), [len(w) for _, w in lists]),
                        _lists(ids.slice(0, 0), [0] * n), _lists(sizes.slice(0, 0), [0] * n), pa.array([0] * n, pa.int32()), pa.array([b""] * n, pa.binary()),
                    ], names=PARTS)
                number += 1

    return run


def _sized(path: str) -> Callable:
    """Lists of words become the numbers of their pieces; all else passes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = pieces(path)
        known: dict[str, int] = {}
        now = None
        for batch in batches:
            size, data = batch.column(5).to_pylist(), batch.column(6).to_pylist()
            for i, bucket in enumerate(batch.column(1).to_pylist()):
                if bucket == WHOLE:
                    continue
                if bucket != now:
                    now = bucket
                    known.clear()
                words = batch.column(2)[i].as_py()
                fresh = [w for w in words if w not in known]
                known.update(zip(fresh, cut.sizes(fresh)))
                size[i], data[i] = packed(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
            columns = batch.columns[:2] + batch.columns[3:5] + [pa.array(size, pa.int32()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*PARTS[:2], *PARTS[3:]])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, from a chunk's frequencies and, behind them, its words' numbers of pieces by bucket."""
    held: tuple | None = None
    each: list[bytes] = []

    def result() -> Iterator[pa.RecordBatch]:
        if held is None:
            return
        ids, sizes, (runs, row, times) = held
        number = np.frombuffer(b"".join(each), np.uint32)
        # Whole numbers up to 2^53 are exact.
        total = np.bincount(row, np.repeat(number, runs) * times.astype(np.float64), len(ids)).astype(np.int64)
        for a in range(0, len(ids), BATCH_ROWS):
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, BATCH_ROWS), sizes.slice(a, BATCH_ROWS), pa.array(total[a: a + BATCH_ROWS])], names=["id", "n_bytes", "n_tokens"],
            )

    for batch in batches:
        for i, (bucket, size, data) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 4, 5)))):
            raw = unpacked(size, data)
            if bucket == WHOLE:
                yield from result()
                held, each = (batch.column(2)[i].values, batch.column(3)[i].values, frequencies(raw)), []
            else:
                each.append(raw)
    yield from result()


def count(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, buckets: int | None = None,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Per row: id, n_bytes (of the text in UTF-8), n_tokens (long)."""
    path = path or vocabulary_path()
    key = docs.schema[id_col].dataType.simpleString()
    buckets = buckets or BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = f"ids array<{key}>, sizes array<long>, size int, data binary"
    chunks = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _chunks(path, buckets, chunk_bytes), f"chunk long, bucket int, words array<string>, {rest}",
    )
    # Frequencies have no bucket and go where their chunk's number falls.
    home = F.when(F.col("bucket") == WHOLE, F.xxhash64("chunk")).otherwise(F.col("bucket"))
    sized = chunks.withColumn("home", home).repartition("home").drop("home").sortWithinPartitions("bucket").mapInArrow(
        _sized(path), f"chunk long, bucket int, {rest}",
    )
    return sized.repartition("chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(
        _summed, f"id {key}, n_bytes long, n_tokens long",
    ).withColumnRenamed("id", id_col)

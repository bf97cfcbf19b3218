"""Phrases whose words go together, from a prefix-free parse of the texts.

1. Parse: a piece of text (what lies between two punctuation marks or line breaks) is cut where the hash of two neighbouring words says so, so
   equal passages are cut alike wherever they stand. A chunk runs from one such pair through the next; the pair is in both chunks.
   The dictionary holds each distinct chunk of a language once, with its frequency in the parse; Spark adds it up.
2. Count: n-grams up to three words are counted in the distinct chunks, weighted by frequency. An n-gram belongs to the chunk in which it begins before
   the closing pair, so the words that two chunks share count once. A task counts some million words at a time and ships for each bucket the
   words and the n-grams as packed numbers; a bucket's task adds them up and lets only n-grams with `least` occurrences out.
   An n-gram's bucket follows from all its words, so a frequent word fills none.
3. Score: joins of those n-grams with their parts, exact in decimal numbers, and the best of each language in two steps.

Words are compared as strings throughout: hashes only place cuts and buckets.

Defined results: a null or empty text has no words; a null language is `und`; repeated rows count each; a long text is read whole; equal
scores go by occurrences, then by the phrase's bytes; columns besides text and language don't matter; without candidates the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradewise.llm import tokens
from gradewise.llm.packing import packed, unpacked
from gradewise.llm.tables import stored

LEAST = 10
TOP = 2000
# One in so many pairs of neighbouring words closes a chunk.
CUT_ONE_IN = 8
OVERLAP = 2
LANGUAGE = "und"
# The bytes that part pieces, and those that part words besides.
PIECE_BYTES = (*b".,;:!?", *range(0x0A, 0x0E))
WORD_BYTES = (0x20, 0x09)

PARTS_PIECE = np.zeros(256, bool)
PARTS_PIECE[list(PIECE_BYTES)] = True
IN_WORD = ~PARTS_PIECE
IN_WORD[list(WORD_BYTES)] = False
NO_SPACE = np.ones(256, bool)
NO_SPACE[0x20] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

PARSE_BYTES = 8 << 20
FLUSH_WORDS = 1_000_000
MERGE_ROWS = 4_000_000
BATCH_ROWS = 20_000
BUCKETS_PER_PARTITION = 2
SALTS = 64


# --- parse ---------------------------------------------------------------------------


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] numbers), then the same for the next."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(size.sum())


def cut(texts: tokens.Texts, one_in: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(chunks as words with a space behind each, whether a chunk closes its piece, the text of each)."""
    data = LOWER[texts.data]
    lowered = tokens.Texts(data, texts.bounds)
    starts, ends, first = lowered.spans(IN_WORD)
    n = len(starts)
    if not n:
        return pa.array([], pa.string()), np.zeros(0, bool), np.zeros(0, np.int64)
    owner = tokens.owners(first)
    marks = np.concatenate(([0], np.cumsum(PARTS_PIECE[data])))
    opens = np.ones(n + 1, bool)
    opens[1:n] = (owner[1:] != owner[:-1]) | (marks[starts[1:]] != marks[ends[:-1]])
    words = lowered.hashes(starts, ends)
    pair = np.zeros(n, bool)
    pair[:-1] = ~opens[1:n] & (tokens.mix(words[:-1] * tokens.BASE + words[1:]) % np.uint64(one_in) == 0)
    begin = np.flatnonzero(opens[:n] | pair)
    stop = np.append(begin[1:], n)
    last = opens[stop]
    size = stop - begin + np.where(last, 0, OVERLAP)
    # The bytes of each word and one space behind it.
    word = _ranges(begin, size)
    length = ends[word] - starts[word] + 1
    at = _ranges(starts[word], length)
    behind = np.cumsum(length) - 1
    at[behind] = 0
    out = data[at]
    out[behind] = 0x20
    offsets = np.concatenate(([0], np.cumsum(length)))[np.concatenate(([0], np.cumsum(size)))]
    chunks = pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])
    return chunks, last, owner[begin]


def _parser(one_in: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        n = 0
        for batch in batches:
            for a, b, texts in tokens.chunks(batch.column(1)):
                chunks, last, owner = cut(texts, one_in)
                if len(chunks):
                    held.append(pa.table({"lang": batch.column(0).slice(a, b - a).take(pa.array(owner)), "last": last, "chunk": chunks}))
                    n += texts.data.nbytes
                if n >= PARSE_BYTES:
                    yield from _distinct(held)
                    held, n = [], 0
        if held:
            yield from _distinct(held)

    return run


def _distinct(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
    counted = pa.concat_tables(held).group_by(["lang", "last", "chunk"]).aggregate([([], "count_all")])
    counted = counted.rename_columns(["lang", "last", "chunk", "n"])
    kinds = pa.schema([("lang", pa.string()), ("last", pa.bool_()), ("chunk", pa.string()), ("n", pa.int64())])
    for batch in counted.to_batches(max_chunksize=BATCH_ROWS):
        yield pa.RecordBatch.from_arrays([c.cast(k.type) for c, k in zip(batch.columns, kinds)], schema=kinds)


def parse(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", cut_one_in: int = CUT_ONE_IN) -> DataFrame:
    """The dictionary: `lang`, `chunk` (a space behind each word), `last` (it closes its piece), `n` (its frequency in the parse)."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(LANGUAGE)).alias("lang"), F.col(text_col).cast("string").alias("text"))
    chunks = texts.mapInArrow(_parser(cut_one_in), "lang string, last boolean, chunk string, n long")
    return chunks.groupBy("lang", "last", "chunk").agg(F.sum("n").alias("n"))


# --- count ---------------------------------------------------------------------------


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of three numbers, in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    most = int(keys.max()) + 1
    if most < 1 << 21:
        one = (keys[:, 0] * most + keys[:, 1]) * most + keys[:, 2]
        order = np.argsort(one)
        one = one[order]
        new = np.concatenate(([True], one[1:] != one[:-1]))
    else:
        order = np.lexsort((keys[:, 2], keys[:, 1], keys[:, 0]))
        ordered = keys[order]
        new = np.concatenate(([True], (ordered[1:] != ordered[:-1]).any(axis=1)))
    lead = np.flatnonzero(new)
    return keys[order[lead]], np.add.reduceat(counts[order], lead)


def _codes(words: pa.Array, langs: pa.Array, lang: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(number of each word of its language from 1 on, the numbers' words with space and language behind)."""
    words, langs = words.dictionary_encode(), langs.dictionary_encode()
    names = langs.dictionary.cast(pa.large_binary())
    both = words.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(names) + langs.indices.to_numpy(zero_copy_only=False)[lang]
    used, code = distinct(both, len(words.dictionary) * len(names))
    told = pc.binary_join_element_wise(
        words.dictionary.take(pa.array(used // len(names))), names.take(pa.array(used % len(names))), pa.scalar(b"", pa.large_binary()),
    )
    # Numbers in the words' order: neighbours that begin alike shrink best.
    order = pc.sort_indices(told)
    number = np.empty(len(told), np.int64)
    number[order.to_numpy()] = np.arange(1, len(told) + 1)
    return number[code], told.take(order)


def distinct(numbers: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """(the different numbers in order, the place of each number among them)."""
    if below > max(1 << 22, 8 * len(numbers)):
        return np.unique(numbers, return_inverse=True)
    there = np.zeros(below, bool)
    there[numbers] = True
    used = np.flatnonzero(there)
    place = np.zeros(below, np.int64)
    place[used] = np.arange(len(used))
    return used, place[numbers]


def _buffers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an array of strings and where each begins, with the end of the last."""
    texts = tokens.texts_of(pa.Array.from_buffers(pa.large_string(), len(words), words.buffers(), offset=words.offset))
    return texts.data, texts.bounds


def _grams(table: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(n-grams as rows of three word numbers, 0 for none; counts; the numbers' words with space and language behind)."""
    texts = tokens.texts_of(table.column("chunk").combine_chunks())
    starts, _, first = texts.spans(NO_SPACE)
    size = np.diff(first)
    owner = tokens.owners(first)
    # A word with the space behind it is a slice of the buffer.
    slices = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(texts.data)).astype(np.int64)), pa.py_buffer(texts.data)],
    )
    code, words = _codes(slices, table.column("lang").combine_chunks(), owner)
    weight = table.column("n").to_numpy()[owner]
    left = np.repeat(size, size) - (np.arange(len(code)) - first[:-1][owner])
    own = left > np.where(table.column("last").to_numpy(), 0, OVERLAP)[owner]
    one = np.flatnonzero(own)
    two = one[left[one] > 1]
    three = two[left[two] > 2]
    keys = np.zeros((len(one) + len(two) + len(three), 3), np.int64)
    keys[:, 0] = code[np.concatenate((one, two, three))]
    keys[len(one):, 1] = code[np.concatenate((two, three)) + 1]
    keys[len(one) + len(two):, 2] = code[three + 2]
    return *added(keys, weight[np.concatenate((one, two, three))]), words


PAYLOAD = ["bucket", "n_words", "n_grams", "words_size", "words", "grams_size", "grams"]


def _counter(buckets: int):
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            # About the batch's words; what is counted at once follows the texts.
            size += int(pc.sum(pc.binary_length(batch.column(2))).as_py() or 0) // 6 + len(batch)
            held.append(batch)
            if size >= FLUSH_WORDS:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).rename_columns(["lang", "last", "chunk", "n"])
        if not len(table):
            return
        keys, counts, words = _grams(table.set_column(2, "chunk", table.column("chunk").cast(pa.large_string())))
        data, bounds = _buffers(words)
        hashes = np.append(np.zeros(1, np.uint64), tokens.Texts(data, bounds).hashes(bounds[:-1], bounds[1:]))
        mixed = np.zeros(len(keys), np.uint64)
        for k in range(3):
            mixed = tokens.mix(mixed + hashes[keys[:, k]] + np.uint64(k))
        bucket = mixed % np.uint64(buckets)
        order = np.argsort(bucket.astype(np.uint16 if buckets < 1 << 16 else np.uint32), kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = []
        for k in np.flatnonzero(np.diff(edges)).tolist():
            rows.append((k, *_payload(keys[order[edges[k]: edges[k + 1]]], counts[order[edges[k]: edges[k + 1]]], words)))
            if len(rows) == 64:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=PAYLOAD)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=PAYLOAD)

    return run


def _payload(keys: np.ndarray, counts: np.ndarray, words: pa.Array) -> tuple:
    """Words and n-grams of one bucket as packed numbers, the n-grams' words renumbered."""
    used, local = distinct(np.append(keys.ravel(), 0), len(words) + 1)
    local = local[:-1].reshape(-1, 3)
    data, bounds = _buffers(words.take(pa.array(used[1:] - 1)))
    # Sorted rows: the first word as steps; each column by itself.
    kind = np.uint16 if len(used) <= 1 << 16 else np.uint32
    columns = [np.diff(local[:, 0], prepend=0).astype(kind), local[:, 1].astype(kind), local[:, 2].astype(kind), counts]
    return len(used) - 1, len(keys), *packed(np.diff(bounds).astype(np.uint32), data), *packed(*columns)


def _adder(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = _Bucket(least)
        now = None
        for batch in batches:
            for k, n_words, n_grams, words_size, words, grams_size, grams in zip(*(c.to_pylist() for c in batch.columns)):
                if k != now:
                    yield from bucket.result()
                    bucket, now = _Bucket(least), k
                bucket.add(unpacked(words_size, words), n_words, unpacked(grams_size, grams), n_grams)
        yield from bucket.result()

    return run


class _Bucket:
    """N-grams of one bucket, by numbers of the words met so far; what has come since the last merge waits."""

    def __init__(self, least: int):
        self.least = least
        self.words = pa.array([], pa.large_binary())
        self.keys, self.counts = np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, words: bytes, n_words: int, raw: bytes, n: int) -> None:
        ends = np.append(0, np.cumsum(np.frombuffer(words, np.uint32, n_words).astype(np.int64)))
        words = pa.Array.from_buffers(pa.large_binary(), n_words, [None, pa.py_buffer(ends), pa.py_buffer(words[4 * n_words:])])
        kind = np.dtype(np.uint16 if n_words < 1 << 16 else np.uint32)
        step = n * kind.itemsize
        columns = [np.cumsum(np.frombuffer(raw, kind, n), dtype=kind), np.frombuffer(raw, kind, n, step), np.frombuffer(raw, kind, n, 2 * step)]
        self.waiting.append((words, np.stack(columns, axis=1), np.frombuffer(raw, np.int64, n, 3 * step)))
        self.size += n
        if self.size > max(MERGE_ROWS, 2 * len(self.keys)):
            self._merge()

    def _merge(self) -> None:
        coded = pa.chunked_array([self.words, *(w for w, _, _ in self.waiting)]).combine_chunks().dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        keys, at = [self.keys], len(self.words)
        for words, own, _ in self.waiting:
            keys.append(np.append(0, code[at: at + len(words)])[own])
            at += len(words)
        self.words = coded.dictionary
        self.keys, self.counts = added(np.concatenate(keys), np.concatenate([self.counts, *(c for _, _, c in self.waiting)]))
        self.waiting, self.size = [], 0

    def result(self) -> Iterator[pa.RecordBatch]:
        """N-grams with `least` occurrences, and for each language all its words' occurrences (no word)."""
        if not self.waiting and not len(self.keys):
            return
        self._merge()
        keys, counts = self.keys, self.counts
        single = np.flatnonzero(keys[:, 1] == 0)
        total: dict[str, int] = {}
        names = self.words.take(pa.array(keys[single, 0] - 1)).to_pylist()
        for name, n in zip(names, counts[single].tolist()):
            lang = name.partition(b" ")[2]
            total[lang] = total.get(lang, 0) + n
        rows = [(lang.decode(), None, None, None, n) for lang, n in total.items()]
        many = np.flatnonzero(counts >= self.least)
        for a in range(0, max(1, len(many)), BATCH_ROWS):
            part = many[a: a + BATCH_ROWS]
            names = [self.words.take(pa.array(keys[part, k] - 1, mask=keys[part, k] == 0)).to_pylist() for k in range(3)]
            for *word, n in zip(*names, counts[part].tolist()):
                apart = [w.partition(b" ") if w is not None else None for w in word]
                rows.append((apart[0][2].decode(), *(w and w[0].decode() for w in apart), n))
            if rows:
                kinds = [pa.string()] * 4 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["lang", "w1", "w2", "w3", "f"])
            rows = []


def count(dictionary: DataFrame, *, least: int = LEAST, buckets: int | None = None) -> DataFrame:
    """(`lang`, `w1`, `w2`, `w3`, `f`) of the n-grams up to three words with `least` occurrences, null for words it hasn't.

    Rows without any word hold parts of the language's number of words.
    """
    buckets = buckets or BUCKETS_PER_PARTITION * int(dictionary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = dictionary.select("lang", "last", "chunk", "n").mapInArrow(
        _counter(buckets), "bucket int, n_words int, n_grams int, words_size int, words binary, grams_size int, grams binary",
    )
    return parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _adder(least), "lang string, w1 string, w2 string, w3 string, f long",
    )


# --- score ---------------------------------------------------------------------------


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) of long numbers; exact while 1000000 * a * a has at most 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    square = (wide(a) * wide(a)).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    parts = wide(left) * wide(right)
    return ((square - square % parts) / parts).cast("long")


def mine(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP,
    cut_one_in: int = CUT_ONE_IN, buckets: int | None = None,
) -> DataFrame:
    """Per language the best `top` phrases: lang, rank, phrase, a, l, r, n, score."""
    dictionary = parse(docs, text_col=text_col, lang_col=lang_col, cut_one_in=cut_one_in)
    return best(stored(count(dictionary, least=least, buckets=buckets), "ngrams"), top)


def best(grams: DataFrame, top: int = TOP) -> DataFrame:
    """The ranking, from what `count` returns."""
    words = grams.where("w1 is not null and w2 is null").select("lang", F.col("w1").alias("w"), F.col("f").alias("fw"))
    pairs = grams.where("w2 is not null and w3 is null").select("lang", "w1", "w2", F.col("f").alias("a"))
    threes = grams.where("w3 is not null").select("lang", "w1", "w2", "w3", F.col("f").alias("a"))
    total = grams.where("w1 is null").groupBy("lang").agg(F.sum("f").alias("n"))

    def with_word(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.join(words.select(F.col("lang"), F.col("w").alias(column), F.col("fw").alias(name)), ["lang", column])

    def with_pair(df: DataFrame, first: str, second: str, name: str) -> DataFrame:
        return df.join(pairs.select(F.col("lang"), F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(name)), ["lang", first, second])

    threes = with_pair(with_pair(threes, "w1", "w2", "left2"), "w2", "w3", "right2")
    # Pairs inside a longer candidate with at least half their occurrences.
    covers = threes.select(
        "lang", F.explode(F.array(F.struct("w1", "w2", F.col("left2").alias("f")), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("right2").alias("f")))).alias("p"), "a",
    ).where(F.col("a") * 100 >= F.col("p.f") * 50).select("lang", "p.w1", "p.w2").distinct()
    kept = with_word(with_word(pairs.join(covers, ["lang", "w1", "w2"], "left_anti"), "w1", "l"), "w2", "r")
    kept = kept.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", score(F.col("a"), F.col("l"), F.col("r")).alias("score"))
    longer = with_word(with_word(threes, "w1", "left1"), "w3", "right1")
    cuts = [score(F.col("a"), F.col("left1"), F.col("right2")), score(F.col("a"), F.col("left2"), F.col("right1"))]
    longer = longer.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.least(
        F.struct(cuts[0].alias("score"), F.lit(1).alias("k"), F.col("left1").alias("l"), F.col("right2").alias("r")),
        F.struct(cuts[1].alias("score"), F.lit(2).alias("k"), F.col("left2").alias("l"), F.col("right1").alias("r")),
    ).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The best of each language among parts of its phrases first, so no task gets a whole language.
    salted = kept.unionByName(longer).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    # One row for each language.
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

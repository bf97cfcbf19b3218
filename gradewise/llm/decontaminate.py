"""Benchmark decontamination by suffix arrays over the training text.

Each task reads its documents in shards of bounded size, sorts the suffixes of a shard's word sequence
(by prefix doubling, to the window's depth), binary-searches every suffix of every benchmark item in
it and joins neighbouring hits to the longest verbatim matches. Documents never cross a shard, so no
match is lost. The benchmark is a query set: it goes to the tasks in blocks of `BLOCK_BYTES`, one pass a block. One block
is all that the driver or a task holds; of several, each pass stores its hits before the next block is collected, and the plan
of the result reads them as one table. With one block nothing is shuffled; with more, the hits are.

Words are runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII. A window is `window`
consecutive words of an item, or the whole item if it has fewer. Defined results: a null or empty
document has no words and no hits; an item without words matches nothing; equal items match alike; a
null item id reads as an empty string; repeated documents are each answered; columns besides the id
and the text don't matter to `find`, and `remove` returns every column as it came.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradewise.llm import tokens
from gradewise.llm.tables import stored
from gradewise.session import scratch_path

WINDOW = 10
SHARD_BYTES = 6 << 20
BLOCK_BYTES = 8 << 20

MATCH = T.ArrayType(T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()),
]))


def word_hashes(texts: tokens.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (never 0) and the number of words before each text."""
    starts, ends, first = texts.spans(tokens.IS_ALNUM)
    hashes = texts.hashes(starts, ends, tokens.LOWER_CODES)
    hashes[hashes == 0] = 1
    return hashes, first


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, in the order of their first `depth` words."""
    n = len(words)
    order = np.argsort(words)
    rank = np.empty(n, np.uint64)
    ordered = words[order]
    rank[order] = np.cumsum(np.concatenate(([True], ordered[1:] != ordered[:-1]))).astype(np.uint64)
    done = 1
    while done < depth:
        step = min(done, depth - done)
        key = rank << np.uint64(32)
        key[: n - step] |= rank[step:]
        order = np.argsort(key)
        ordered = key[order]
        rank[order] = np.cumsum(np.concatenate(([True], ordered[1:] != ordered[:-1]))).astype(np.uint64)
        done += step
        if rank[order[-1]] == n:
            break
    return order


@dataclass
class Items:
    """Distinct windows of distinct item texts.

    `words` holds the texts one behind the other; window k is words[start[k]: start[k] + size[k]], and
    `places[first[k]: first[k + 1]]` are all its positions in `words`, `text` the text of each.
    `ids[t]` are the items with text t.
    """

    words: np.ndarray
    start: np.ndarray
    size: np.ndarray
    first: np.ndarray
    places: np.ndarray
    text: np.ndarray
    ids: list[list[str]]


def index_items(ids: list, texts: list, window: int) -> Items:
    hashes, first = word_hashes(tokens.texts_of(pa.array(texts, pa.large_string())))
    groups: dict[bytes, int] = {}
    members: list[list[str]] = []
    parts: list[np.ndarray] = []
    for i, item in enumerate(ids):
        words = hashes[first[i]: first[i + 1]]
        if not len(words):
            continue
        at = groups.setdefault(words.tobytes(), len(members))
        if at == len(members):
            members.append([])
            parts.append(words)
        members[at].append("" if item is None else str(item))
    if not parts:
        none = np.zeros(0, np.int64)
        return Items(np.zeros(0, np.uint64), none, none, np.zeros(1, np.int64), none, none, [])
    words = np.concatenate(parts)
    start, size, text, keys = [], [], [], []
    base = 0
    for t, part in enumerate(parts):
        width = min(window, len(part))
        for j in range(len(part) - width + 1):
            start.append(base + j)
            size.append(width)
            text.append(t)
            keys.append(part[j: j + width].tobytes())
        base += len(part)
    order = sorted(range(len(keys)), key=keys.__getitem__)
    lead = [k for n, k in enumerate(order) if n == 0 or keys[k] != keys[order[n - 1]]]
    opens = [n for n, k in enumerate(order) if n == 0 or keys[k] != keys[order[n - 1]]]
    start, size, text = np.array(start), np.array(size), np.array(text)
    return Items(
        words, start[lead], size[lead], np.array([*opens, len(order)]), start[order], text[order], members,
    )


def locate(words: np.ndarray, suffixes: np.ndarray, items: Items, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Range of `suffixes` that begins with each window; `words` ends with `depth` zeros."""
    low = np.zeros(len(items.start), np.int64)
    high = np.full(len(items.start), len(suffixes), np.int64)
    for d in range(depth):
        live = np.flatnonzero((items.size > d) & (low < high))
        if not len(live):
            break
        wanted = items.words[items.start[live] + d]
        bounds = []
        for beyond in (False, True):
            a, b = low[live], high[live]
            while (open_ := a < b).any():
                middle = (a + b) >> 1
                found = words[suffixes[np.minimum(middle, len(suffixes) - 1)] + d]
                right = open_ & ((found < wanted) | (beyond & (found == wanted)))
                a, b = np.where(right, middle + 1, a), np.where(open_ & ~right, middle, b)
            bounds.append(a)
        low[live], high[live] = bounds
    return low, high


def search(texts: tokens.Texts, items: Items, window: int) -> dict:
    """Words of each text, and per text with a hit: covered words, item texts found, longest matches."""
    hashes, first = word_hashes(texts)
    count = np.diff(first)
    out = {"n_words": count, "hits": {}}
    if not len(hashes) or not len(items.start):
        return out
    # One zero, which no item has, behind each text keeps matches inside a text.
    owner = tokens.owners(first)
    words = np.zeros(len(hashes) + len(count) + window, np.uint64)
    words[np.arange(len(hashes)) + owner] = hashes
    suffixes = suffix_array(words, window)
    suffixes = suffixes[words[suffixes] != 0]
    low, high = locate(words, suffixes, items, window)
    found = np.flatnonzero(high > low)
    if not len(found):
        return out
    times = (high - low)[found]
    hit = np.repeat(found, times)
    at = suffixes[np.repeat(low[found] - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())]
    begin = first[:-1] + np.arange(len(count))
    doc = np.searchsorted(begin, at, "right") - 1
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + items.size[hit], -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(cover)[:-1] > 0)))
    # Neighbouring windows of one item text on one diagonal make one longest match.
    many = np.diff(items.first)[hit]
    place = np.repeat(items.first[hit] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
    p, e, size = np.repeat(at, many), items.places[place], np.repeat(items.size[hit], many)
    order = np.lexsort((p, p - e))
    p, e, size, text = p[order], e[order], size[order], items.text[place][order]
    new = np.concatenate(([True], (p[1:] != p[:-1] + 1) | (e[1:] != e[:-1] + 1) | (text[1:] != text[:-1])))
    lead = np.flatnonzero(new)
    last = np.concatenate((lead[1:], [len(p)])) - 1
    run_doc = np.searchsorted(begin, p[lead], "right") - 1
    for d in np.unique(doc):
        out["hits"][int(d)] = {
            "n_hit": int(covered[begin[d] + count[d]] - covered[begin[d]]), "texts": set(), "matches": [],
        }
    for d, t, s, f in zip(run_doc.tolist(), text[lead].tolist(), p[lead].tolist(), (p[last] + size[last]).tolist()):
        hit_of = out["hits"][d]
        hit_of["texts"].add(t)
        hit_of["matches"].append((t, s - int(begin[d]), f - int(begin[d])))
    return out


def _query_set(items: DataFrame, item_id: str, item_text: str) -> tuple[DataFrame, int]:
    """The query set and its number of blocks; of several blocks, it is stored by block (`part`)."""
    rows = items.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")).where("t is not null")
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    if n > 1:
        # Items with one text lie in one block.
        part = F.pmod(F.xxhash64("t"), F.lit(n)).cast("int")
        path = scratch_path(items.sparkSession, "items")
        rows.distinct().withColumn("part", part).repartition("part").write.partitionBy("part").parquet(path)
        rows = items.sparkSession.read.schema("i string, t string, part int").parquet(path)
    return rows, n


def _block(rows: DataFrame, k: int, n: int) -> tuple[list, list]:
    got = (rows if n == 1 else rows.where(F.col("part") == k)).collect()
    return [r.i for r in got], [r.t for r in got]


def _hits(docs: DataFrame, rows: DataFrame, n: int, window: int) -> DataFrame:
    """(`row`, `block`, `item_ids`, `matches`) of the stored documents (`row`, `text`) and blocks with a match: one pass a block."""
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("item_ids", T.ArrayType(T.StringType())), T.StructField("matches", MATCH)])
    path = scratch_path(docs.sparkSession, "hits")
    for k in range(n):
        ids, texts = _block(rows, k, n)
        docs.select("row", "text").mapInArrow(_hitter(ids, texts, window), schema).withColumn("block", F.lit(k)).write.mode("append").parquet(path)
    return docs.sparkSession.read.schema(schema.add("block", T.IntegerType())).parquet(path)


def _covered(matches: str) -> Column:
    """How many words the union of the matches covers."""
    ordered = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"], m["end"])))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    return F.aggregate(
        ordered, zero,
        lambda a, m: F.struct(
            (a["n"] + F.greatest(F.lit(0).cast("long"), m["end"] - F.greatest(m["start"], a["to"]))).alias("n"),
            F.greatest(a["to"], m["end"]).alias("to"),
        ),
        lambda a: a["n"],
    )


def find(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """Per document: id, n_words, n_hit, item_ids (sorted array), matches (item_id, start, end in words).

    A match names the first of the items with its text. `n_hit` counts words inside any window's occurrence.
    """
    id_field = T.StructField("id", docs.schema[id_col].dataType)
    rows, n = _query_set(items, item_id, item_text)
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counted = T.StructField("n_words", T.LongType())
    if n < 2:
        ids, texts = _block(rows, 0, n) if n else ([], [])
        out = out.mapInArrow(_finder(ids, texts, window), T.StructType([
            id_field, counted, T.StructField("n_hit", T.LongType()), T.StructField("item_ids", T.ArrayType(T.StringType())), T.StructField("matches", MATCH),
        ]))
    else:
        known = out.mapInArrow(_count_words, T.StructType([id_field, T.StructField("text", T.StringType()), counted]))
        known = stored(known.withColumn("row", F.monotonically_increasing_id()), "documents")
        found = _hits(known, rows, n, window).groupBy("row").agg(
            F.array_sort(F.collect_list(F.struct("block", "item_ids", "matches"))).alias("found"),
        ).select(
            F.col("row").alias("hit_row"), F.array_sort(F.array_distinct(F.flatten("found.item_ids"))).alias("item_ids"),
            # By place, whichever block they come from.
            F.transform(
                F.array_sort(F.transform(F.flatten("found.matches"), lambda m: F.struct(m["start"], m["end"], m["item_id"]))),
                lambda m: F.struct(m["item_id"], m["start"], m["end"]),
            ).alias("matches"),
        )
        out = known.select("row", "id", "n_words").join(found, F.col("row") == F.col("hit_row"), "left").select(
            "id", "n_words", F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            F.coalesce("matches", F.array().cast(MATCH)).alias("matches"),
        ).select("id", "n_words", _covered("matches").alias("n_hit"), "item_ids", "matches")
    return out.withColumnRenamed("id", id_col)


def _shards(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, tokens.Texts]]:
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        for a, b, shard in tokens.chunks(texts, SHARD_BYTES):
            yield batch.slice(a, b - a), shard


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, shard in _shards([batch], "text"):
            n = np.diff(word_hashes(shard)[1])
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(n, pa.int64())], names=["id", "text", "n_words"])


def _told(hit: dict, items: Items) -> tuple[list[str], list[dict]]:
    """Sorted item ids and the matches of one document's hit."""
    ids = sorted({x for t in hit["texts"] for x in items.ids[t]})
    told = sorted((s, e, min(items.ids[t])) for t, s, e in hit["matches"])
    return ids, [{"item_id": i, "start": s, "end": e} for s, e, i in told]


_ITEM_IDS = pa.list_(pa.string())
_MATCHES = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _hitter(ids: list, texts: list, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = index_items(ids, texts, window)
        for rows, shard in _shards(batches, "text"):
            hits = search(shard, items, window)["hits"]
            told = [_told(hit, items) for hit in hits.values()]
            yield pa.RecordBatch.from_arrays([
                rows.column(0).take(pa.array(list(hits), pa.int64())), pa.array([t[0] for t in told], _ITEM_IDS), pa.array([t[1] for t in told], _MATCHES),
            ], names=["row", "item_ids", "matches"])

    return run


def _finder(ids: list, texts: list, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = index_items(ids, texts, window)
        for rows, shard in _shards(batches, "text"):
            got = search(shard, items, window)
            told = [_told(got["hits"][i], items) if i in got["hits"] else ([], []) for i in range(len(shard))]
            n_hit = [got["hits"][i]["n_hit"] if i in got["hits"] else 0 for i in range(len(shard))]
            yield pa.RecordBatch.from_arrays([
                rows.column(0), pa.array(got["n_words"], pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array([t[0] for t in told], _ITEM_IDS), pa.array([t[1] for t in told], _MATCHES),
            ], names=["id", "n_words", "n_hit", "item_ids", "matches"])

    return run


def remove(
    docs: DataFrame, items: DataFrame, *, text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """The documents in which no window of any item occurs, with all their columns."""
    rows, n = _query_set(items, item_id, item_text)
    if n < 2:
        return docs.mapInArrow(_remover(_block(rows, 0, n)[1], text_col, window), docs.schema) if n else docs
    every = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    known = stored(docs.select(every, F.monotonically_increasing_id().alias("row")), "documents")
    hit = _hits(known.select("row", F.col("doc").getField(text_col).alias("text")), rows, n, window).select("row").distinct()
    return known.join(hit, "row", "left_anti").select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))


def _remover(texts: list, column: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = index_items([None] * len(texts), texts, window)
        for rows, shard in _shards(batches, column):
            hits = search(shard, items, window)["hits"]
            yield rows.filter(pa.array([i not in hits for i in range(len(shard))]))

    return run

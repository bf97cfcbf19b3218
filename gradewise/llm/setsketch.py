"""Near-duplicate groups by SetSketch registers.

A text's set holds its distinct shingles of `SHINGLE` words (A-Z lower-cased), or the whole sequence if it
has fewer words. Register i of a set is its smallest hash under function i as an exponential variate, on a
logarithmic scale with base `B`: floor(1 - log_B(minimum)), cut off to 16 bits. Registers of a union are the larger
ones of both, and two sets agree in a register about as often as their Jaccard similarity says.

1. Texts with equal sets (by a 128-bit fingerprint) become one node.
2. Registers are banded; nodes that agree in a band share a bucket.
3. Shingles are counted over the texts of those nodes. A pair can't share shingles that only one of the two has, which bounds its
   similarity exactly; nodes with too many shingles of their own are linked with nothing and leave.
4. Every node is estimated against its buckets' leaders: the similarity of greatest likelihood, given how many registers are larger,
   equal and smaller. Of those that may reach the threshold the best is verified on the full sets.
5. What is left of each bucket is compared until no two nodes of different components are uncompared: in each round
   at most about `LEADERS` nodes outside a bucket's largest component meet all the others, in chunks of about `CHUNK` nodes with their
   texts, and only links come out, one for each leader and component.

So a group of n near copies costs about n verified pairs and the comparison of the few that stay outside, no task gets a whole
bucket, and no link between nodes that share a bucket is passed over. Two sets at the threshold share no bucket with probability
(1 - 0.85^5)^24 < 1e-6 (7e-5 at 0.8), and the estimate's margin is five standard deviations.

Defined results: null and empty texts have no set, are linked with nothing and stay; rows with a null id likewise, with a
null component; repeated rows are copies of each other, and `keep_one` keeps one of them; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewise.llm import tokens
from gradewise.llm.tables import stored

SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
B = 1.001
RATE = 20.0
TOP = (1 << 16) - 1
MARGIN = 0.17
LEADERS = 512
CHUNK = 1024
CHUNK_SHINGLES = 1 << 20

FACTORS = np.random.default_rng(42).integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SALT = tokens.mixed_int(5)


def shingles(texts: tokens.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all distinct shingles, text by text, and how many come before each text."""
    starts, ends, first = texts.spans(tokens.IS_WORD)
    words = texts.hashes(starts, ends, tokens.LOWER_CODES)
    keys, at = tokens.windows(words, first, SHINGLE)
    owner = tokens.owners(first)[at] if len(at) else at
    for i in np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < SHINGLE)):
        few = np.full(1, first[i + 1] - first[i], np.uint64)
        for k in range(first[i], first[i + 1]):
            few = few * tokens.BASE + words[k: k + 1]
        keys, owner = np.append(keys, tokens.mix(few)), np.append(owner, i)
    _, later = tokens.repeated(tokens.mix(keys ^ (owner.astype(np.uint64) * tokens.BASE)))
    keys, owner = keys[~later], owner[~later]
    order = np.argsort(owner, kind="stable")
    return keys[order], np.searchsorted(owner[order], np.arange(len(texts) + 1))


def registers(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Registers of each set that isn't empty, a row each."""
    begins = first[:-1][np.diff(first) > 0]
    out = np.empty((len(begins), REGISTERS), np.uint16)
    for i in range(REGISTERS):
        if len(begins):
            least = np.minimum.reduceat(keys * FACTORS[i], begins)
            variate = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
            out[:, i] = np.clip(np.floor(1 - np.log(variate) / np.log(B)), 0, TOP)
    return out


def band_keys(rows: np.ndarray) -> np.ndarray:
    """The bucket of each band, a column each."""
    keys = np.empty((len(rows), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(rows), band + 1, np.uint64)
        for k in range(ROWS):
            key = tokens.mix(key * tokens.BASE + rows[:, band * ROWS + k])
        keys[:, band] = key
    return keys


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity of greatest likelihood of each pair of register rows, on a grid of 0.01."""
    larger, smaller = (a > b).sum(-1), (a < b).sum(-1)
    equal = a.shape[-1] - larger - smaller
    u = (n_a / (n_a + n_b))[..., None]
    v = 1 - u
    grid = np.linspace(0.0, 1.0, 101)
    most = np.minimum(u / v, v / u)
    j = np.minimum(grid, most)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / np.log(B)

    up, down = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    chance = (
        larger[..., None] * np.log(up + tiny) + smaller[..., None] * np.log(down + tiny)
        + equal[..., None] * np.log(np.maximum(1 - up - down, tiny))
    )
    return np.take_along_axis(np.broadcast_to(j, chance.shape), chance.argmax(-1)[..., None], -1)[..., 0]


SKETCH = "text_hash long, n long, print binary, registers binary, bands array<long>"


def _sketcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, texts in tokens.chunks(batch.column(1)):
            keys, first = shingles(texts)
            n = np.diff(first)
            sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(k))) for k in (keys, tokens.mix(keys ^ SALT))]
            prints = np.stack([s[first[1:]] - s[first[:-1]] for s in sums], 1)
            rows = registers(keys, first)
            keys_of = band_keys(rows).view(np.int64)
            some, k = [], 0
            for size in n.tolist():
                some.append(k if size else None)
                k += bool(size)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(n, pa.int64()),
                pa.array([None if k is None else p.tobytes() for k, p in zip(some, prints)], pa.binary()),
                pa.array([None if k is None else rows[k].tobytes() for k in some], pa.binary()),
                pa.array([None if k is None else keys_of[k] for k in some], pa.list_(pa.int64())),
            ], names=["id", "text_hash", "n", "print", "registers", "bands"])


def sketch(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, text_hash, n (size of its set), print, registers, bands; the last three null without a set."""
    key = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash")).mapInArrow(_sketcher, f"id {key}, {SKETCH}")


def _may_link(a, b, n_a, n_b, m_a, m_b, percent: int) -> np.ndarray:
    """Whether pairs of sets of sizes n, of which m shingles are in other texts too, may reach the similarity."""
    most = np.minimum(m_a, m_b)
    bound = (100 + percent) * most >= percent * (n_a + n_b)
    out = np.zeros(len(bound), bool)
    at = np.flatnonzero(bound)
    out[at] = estimate(a[at], b[at], n_a[at], n_b[at]) >= percent / 100 - MARGIN
    return out


def _rows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (`a`, `b`) of nodes those that may be linked, with the estimated similarity."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, len(whole), 1024):
                batch = whole.slice(k, 1024)
                n_a, n_b, m_a, m_b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4, 5))
                r_a, r_b = _rows(batch.column(6)), _rows(batch.column(7))
                keep = np.flatnonzero(_may_link(r_a, r_b, n_a, n_b, m_a, m_b, percent))
                got = estimate(r_a[keep], r_b[keep], n_a[keep], n_b[keep])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep)), pa.array(got)], names=["a", "b", "similarity"],
                )

    sides = [
        nodes.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "m", "registers"))) for x in ("a", "b")
    ]
    return (
        pairs.join(sides[1], "b").join(sides[0], "a").select("a", "b", "n_a", "n_b", "m_a", "m_b", "registers_a", "registers_b")
        .mapInArrow(judge, "a long, b long, similarity double")
    )


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Of the distinct pairs (`a`, `b`) those whose full sets are similar enough; `texts`: node, n, text.

    The pairs of one `a` are dealt to chunks of about `CHUNK_SHINGLES` shingles, each with its copy of a's text.
    """
    sized = pairs.join(texts.select(F.col("node").alias("b"), "n"), "b")
    parts = sized.groupBy("a").agg(F.ceil(F.sum("n") / CHUNK_SHINGLES).cast("long").alias("parts"))
    dealt = sized.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    members = dealt.join(texts.select(F.col("node").alias("b"), "text"), "b").select("a", "part", "b", "text")
    heads = (
        parts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        .join(texts.select(F.col("node").alias("a"), "text"), "a")
        .select("a", "part", F.col("a").alias("b"), "text")
    )
    return members.unionByName(heads).groupBy("a", "part").applyInArrow(_verify(percent), "a long, b long")


def _verify(percent: int):
    def run(table: pa.Table) -> pa.Table:
        a, nodes = table.column("a")[0].as_py(), table.column("b").to_pylist()
        sets: dict[int, np.ndarray] = {}
        row = 0
        for chunk in table.column("text").chunks:
            for _, _, texts in tokens.chunks(chunk):
                keys, first = shingles(texts)
                for i in range(len(texts)):
                    sets[nodes[row]] = np.sort(keys[first[i]: first[i + 1]])
                    row += 1
        own = sets[a]
        linked = []
        for b, other in sets.items():
            at = np.minimum(np.searchsorted(own, other), len(own) - 1)
            both = int((own[at] == other).sum())
            if b != a and 100 * both >= percent * (len(own) + len(other) - both):
                linked.append(b)
        return pa.table({"a": pa.array([a] * len(linked), pa.int64()), "b": pa.array(linked, pa.int64())})

    return run


def shared_sizes(texts: DataFrame) -> DataFrame:
    """(node, m): how many of the shingles of each node's text another node's text has too."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part in tokens.chunks(batch.column(1), tokens.CHUNK_BYTES // 4):
                keys, first = shingles(part)
                nodes = np.repeat(batch.column(0).slice(a, b - a).to_numpy(), np.diff(first))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(nodes)], names=["shingle", "node"])

    places = texts.select("node", "text").mapInArrow(each, "shingle long, node long")
    lone = places.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("last")).where("node = last")
    alone = lone.groupBy("node").agg(F.count("*").alias("alone"))
    sizes = texts.groupBy("node").agg(F.first("n").alias("n"))
    return sizes.join(alone, "node", "left").select("node", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component: its smallest node) of every node with an edge.

    Each node points at the smallest of itself and its neighbours; pointers are doubled until they end at roots,
    and the edges between roots are what the next round works on.
    """
    left = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")), "points")
        while True:
            onward = point.select(F.col("a").alias("p"), F.col("p").alias("q"))
            jumped = stored(point.join(onward, "p").select("a", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("moved")), "points")
            if jumped.where("moved").isEmpty():
                break
            point = jumped.drop("moved")
        if labels is None:
            labels = point.select(F.col("a").alias("node"), F.col("p").alias("component"))
        else:
            step = point.select(F.col("a").alias("component"), "p")
            labels = stored(
                labels.join(step, "component", "left").select("node", F.coalesce("p", "component").alias("component")), "labels",
            )
        to = point.select("a", F.col("p").alias("to_a"))
        other = point.select(F.col("a").alias("b"), F.col("p").alias("to_b"))
        left = stored(
            left.join(to, "a").join(other, "b").where("to_a <> to_b")
            .select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).distinct(), "edges",
        )
    return labels if labels is not None else left.select(F.col("a").alias("node"), F.col("b").alias("component"))


def joined(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """The labels (`node`, `component`) after more edges; of nodes with an edge only."""
    if labels is None:
        return components(edges)
    ends = stored(
        _labelled(_labelled(edges.select(F.col("a").alias("node"), "b"), labels).select(F.col("b").alias("node"), F.col("component").alias("a")), labels)
        .select("a", F.col("component").alias("b")), "ends",
    )
    step = components(ends)
    fresh = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().join(labels, "node", "left_anti")
    every = labels.unionByName(fresh.withColumn("component", F.col("node")))
    moved = step.select(F.col("node").alias("component"), F.col("component").alias("to"))
    return stored(every.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels")


def _labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    return nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _sets(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted set of each text, one behind the other, and where each begins."""
    parts, sizes = [np.zeros(0, np.uint64)], []
    for chunk in column.chunks:
        for _, _, texts in tokens.chunks(chunk):
            keys, first = shingles(texts)
            parts += [np.sort(keys[first[i]: first[i + 1]]) for i in range(len(texts))]
            sizes.append(np.diff(first))
    return np.concatenate(parts), np.concatenate(([0], np.cumsum(np.concatenate(sizes))))


def _meet(percent: int):
    share = percent / 100
    # Equal registers of a pair at the threshold, less five standard deviations.
    least_equal = REGISTERS * share - 5 * np.sqrt(REGISTERS * share * (1 - share))

    def run(table: pa.Table) -> pa.Table:
        """Links of a chunk's leaders to members of other components, one for each leader and component.

        A pair is looked at in the first of the bands that it shares only.
        """
        lead = table.column("leads").to_numpy(zero_copy_only=False).astype(bool)
        node, part, n, m = (table.column(c).to_numpy() for c in ("node", "component", "n", "m"))
        rows = _rows(table.column("registers"))
        keys, first = _sets(table.column("text"))
        bucket = table.column("bucket")[0].as_py()
        band = int(np.flatnonzero(band_keys(rows[:1]).view(np.int64)[0] == bucket)[0])
        members = np.flatnonzero(~lead)
        member_keys = np.concatenate([keys[first[j]: first[j + 1]] for j in members] or [keys[:0]])
        begins = np.concatenate(([0], np.cumsum(n[members])))
        found: list[tuple[int, int]] = []
        for k in np.flatnonzero(lead):
            most = np.minimum(m[k], m[members])
            some = (part[members] != part[k]) & ((100 + percent) * most >= percent * (n[k] + n[members]))
            at = np.flatnonzero(some)
            same = rows[members[at]] == rows[k]
            shared = same.reshape(len(at), BANDS, ROWS).all(2).argmax(1)
            at = at[(same.sum(1) >= least_equal) & (shared == band)]
            if not len(at):
                continue
            own = keys[first[k]: first[k + 1]]
            sizes = n[members[at]]
            place = np.repeat(begins[at] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
            theirs = member_keys[place]
            hit = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
            both = np.add.reduceat(hit.astype(np.int64), np.concatenate(([0], np.cumsum(sizes)[:-1])))
            linked = members[at[100 * both >= percent * (n[k] + sizes - both)]]
            _, one = np.unique(part[linked], return_index=True)
            found += [(int(node[k]), int(node[j])) for j in linked[one]]
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _round(
    members: DataFrame, nodes: DataFrame, texts: DataFrame, labels: DataFrame, turn: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """(links found, members whose buckets aren't finished, without this round's leaders)."""
    placed = _labelled(members, labels)
    shares = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    buckets = (
        shares.groupBy("bucket")
        .agg(F.sum("n").alias("size"), F.count("*").alias("parts"), F.max(F.struct("n", "component")).alias("top"))
        .where("parts > 1")
        .select("bucket", "size", F.col("top.component").alias("main"), (F.col("size") - F.col("top.n")).alias("rest"))
    )
    chance = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 20)) * F.col("rest") < F.lit(LEADERS << 20)
    open_ = stored(
        placed.join(buckets, "bucket").select(
            "bucket", "node", "component", ((F.col("component") != F.col("main")) & chance).alias("leads"),
            F.ceil(F.col("size") / CHUNK).cast("long").alias("chunks"),
        ), "open",
    )
    own = open_.withColumn("leads", F.lit(False)).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
    everywhere = open_.where("leads").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)),
    )
    known = nodes.select("node", "n", "m", "registers").join(texts.groupBy("node").agg(F.first("text").alias("text")), "node")
    columns = ["bucket", "chunk", "node", "component", "leads"]
    full = own.select(columns).unionByName(everywhere.select(columns)).join(known, "node")
    links = full.groupBy("bucket", "chunk").applyInArrow(_meet(percent), "a long, b long")
    return links, open_.where("not leads").select("bucket", "node")


def groups(docs: DataFrame, *, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_shingles, component_id (the smallest id of its component), kept."""
    found = _grouped(docs, percent, id_col, text_col)
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _grouped(docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Per document: id, n (shingles), text_hash, component (null without a set or id) and component_id."""
    sketches = stored(sketch(docs, id_col=id_col, text_col=text_col), "sketches")
    nodes = stored(
        sketches.where("n > 0 and id is not null").groupBy("print")
        .agg(F.min("id").alias("first"), F.first("n").alias("n"), F.first("registers").alias("registers"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes",
    )
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(buckets.join(shared, "bucket").select("bucket", "node"), "members")
    labels = _links(docs, nodes, members, percent, id_col, text_col)

    placed = _labelled(nodes.select("node", "print", "first"), labels)
    smallest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = placed.join(smallest, "component").select("print", "component", "component_id")
    out = sketches.select("id", "n", "print", "text_hash").join(named, "print", "left")
    whole = (F.col("n") > 0) & F.col("id").isNotNull()
    return out.select(
        "id", "n", "text_hash", F.when(whole, F.col("component")).alias("component"),
        F.when(whole, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def _links(docs: DataFrame, nodes: DataFrame, members: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Labels of all nodes that are linked."""
    wanted = members.select("node").distinct().join(nodes.select("node", "n", "first", "print"), "node")
    texts = docs.select(F.col(id_col).alias("first"), F.col(text_col).alias("text")).join(wanted, "first")
    # An id that stands for several texts brings them all; the node's own is the one with its print.
    texts = stored(texts.mapInArrow(_own_texts, "node long, n long, text string"), "texts")
    able = shared_sizes(texts).join(nodes.select("node", "n", "registers"), "node").where(f"100 * m >= {percent} * n")
    nodes = stored(able, "able")
    # The leader has the largest share of shingles that others have, as the original of a group of copies does.
    central = F.struct(F.col("m") / F.col("n"), -F.col("node"))
    members = stored(members.join(nodes.select("node", "m", "n"), "node").select("bucket", "node", central.alias("central")), "members")
    leaders = members.groupBy("bucket").agg((-F.max("central").getField("col2")).alias("a"), F.count("*").alias("size")).where("size > 1")
    members = stored(members.join(leaders, "bucket").select("bucket", "node", "a"), "members")
    stars = plausible(members.where("node <> a").select("a", F.col("node").alias("b")).distinct(), nodes, percent)
    best = stars.groupBy("b").agg(F.max_by("a", F.struct("similarity", "a")).alias("a"))
    labels = joined(None, verified(stored(best, "stars"), texts, percent))
    members = members.select("bucket", "node")
    turn = 0
    while True:
        links, members = _round(members, nodes, texts, labels, turn, percent)
        if members.isEmpty():
            return labels
        found = stored(links, "links")
        if not found.isEmpty():
            labels = joined(labels, found)
        turn += 1


def _own_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (first, text, node, n, print) those whose text has the print; of repeated ones in a batch one."""
    for batch in batches:
        seen: set[int] = set()
        at = {n: batch.schema.get_field_index(n) for n in batch.schema.names}
        prints = batch.column(at["print"]).to_pylist()
        for a, b, texts in tokens.chunks(batch.column(at["text"])):
            keys, first = shingles(texts)
            sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(k))) for k in (keys, tokens.mix(keys ^ SALT))]
            found = np.stack([s[first[1:]] - s[first[:-1]] for s in sums], 1)
            own = [found[i].tobytes() == prints[a + i] for i in range(b - a)]
            for i in np.flatnonzero(own).tolist():
                node = batch.column(at["node"])[a + i].as_py()
                own[i] = node not in seen
                seen.add(node)
            rows = batch.slice(a, b - a).filter(pa.array(own))
            yield pa.RecordBatch.from_arrays([rows.column(at[n]) for n in ("node", "n", "text")], names=["node", "n", "text"])


def keep_one(docs: DataFrame, *, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, and every document without a set or id, with all columns.

    It is a row with the component's smallest id; of several such rows the text with the smallest hash stays, and of rows of one id and
    text the smallest by their columns.
    """
    found = _grouped(docs, percent, id_col, text_col).where("component is not null and id = component_id")
    chosen = found.groupBy("component", "id", "text_hash").agg(F.count("*").alias("copies")).groupBy("component").agg(
        F.min(F.struct("text_hash", "id", "copies")).alias("one"),
    ).select(F.col("one.id").alias("id"), F.col("one.text_hash").alias("text_hash"), F.col("one.copies").alias("copies"))
    chosen = chosen.select(F.struct("*").alias("kept"))
    every = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    has_words = F.col(text_col).rlike(r"[^\x20\x09-\x0D]")
    rows = docs.select(every, F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), (F.col(id_col).isNotNull() & F.coalesce(has_words, F.lit(False))).alias("filled"))
    joined = rows.where("filled").join(chosen, (F.col("id") == F.col("kept.id")) & (F.col("text_hash") == F.col("kept.text_hash"))).select("doc", "kept")
    alone = joined.where("kept.copies = 1").select("doc")
    several = joined.where("kept.copies > 1").groupBy("kept").agg(F.min("doc").alias("doc")).select("doc")
    kept = alone.unionByName(several).unionByName(rows.where("not filled").select("doc"))
    return kept.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))

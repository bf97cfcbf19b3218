"""WARC archives with a two-level capture index.

`write` stores pages in archives of gzip members, one a record, in the order in which they come. Their index lines, which
are small, are range-partitioned and sorted by reversed-host URL key and stored in compressed blocks of `BLOCK_LINES` lines. The
directory, a Parquet table, has one row for each block: its first and last key and where it lies. `read_back` reads every
record through it, in archive order; `lookup` binary-searches the directory for URLs, then their blocks, and range-reads just
those records. It takes any number of URLs: their keys are shuffled to the blocks, so none passes the driver.

Files go through Arrow's file systems to a folder that all machines share, under a name of the task's own; only
what a finished task reports reaches the directory, so a lost or repeated task leaves at most an unused
file. Payloads are compared by SHA-256. Of pages with equal payloads of `REVISIT_BYTES` or more, that with the
smallest id is a response and the rest are revisits of it; a hot payload costs partial sums of small
rows, not payload traffic.

Defined results: a null or empty payload is an empty response; a null URL has the empty key and no target URI; rows
with one id and one payload are alike, so copies of the smallest are all responses; a null id is never
smaller than another id; an empty table gives an archive without records; other columns are passed over.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewise.llm.tables import stored

BLOCK_LINES = 300
REVISIT_BYTES = 100
READ_BYTES = 8 << 20
LOOKUP_BYTES = 8 << 20
HELD_BYTES = 4 << 20

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time
CAPTURE = "key string, archive string, offset long, length long, kind string, page string"
DIRECTORY = "first_key string, last_key string, index string, offset long, length long, lines long, bytes long"


def url_key(url: str | Column) -> Column:
    """Host parts from the last to the first, then `)` and the rest: com,example,m)/en/a.html?x=1"""
    url = F.col(url) if isinstance(url, str) else url
    pattern = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?(.*)$"
    host = F.lower(F.regexp_extract(url, pattern, 1))
    key = F.concat(
        F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_extract(url, pattern, 2),
    )
    # Index lines hold one key each.
    return F.regexp_replace(F.coalesce(F.when(host != "", key).otherwise(url), F.lit("")), r"[\x00-\x20]", "%20")


def _files(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))


def _urn(page: str | None) -> str:
    """A page's name in a header, whatever characters its id has."""
    return "<urn:unnamed>" if page is None else f"<urn:page:{quote(page, safe='')}>"


def _page(urn: str) -> str | None:
    return None if urn == "<urn:unnamed>" else unquote(urn.removeprefix("<urn:page:").removesuffix(">"))


def _record(kind: str, page: str | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: str | None) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20]", "%20", url))
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}", "Content-Type: text/html; charset=utf-8"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
        payload = b""
    lines.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and content of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def revisits(pages: DataFrame, *, id_col: str, body_col: str) -> DataFrame:
    """(`id`, `digest`, `refers_to`) of the pages whose payload another page holds; no payload is shuffled."""
    body = F.coalesce(F.col(body_col), F.lit(""))
    sizes = stored(pages.select(
        F.col(id_col).alias("id"), F.sha2(body, 256).alias("digest"), F.octet_length(body).cast("long").alias("size"),
    ), "digests")
    large = sizes.where(F.col("size") >= REVISIT_BYTES)
    firsts = large.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    return (
        large.join(firsts.drop("n"), "digest")
        .where(F.col("refers_to").isNotNull() & ~F.col("id").eqNullSafe(F.col("refers_to")))
        .select("id", "digest", "refers_to").distinct()
    )


def write(
    pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
) -> DataFrame:
    """Write archives, indexes and the directory below `path`; returns the directory."""
    spark = pages.sparkSession
    body = F.coalesce(F.col(body_col), F.lit(""))
    rows = pages.select(
        url_key(url_col).alias("key"), F.col(id_col).alias("id"), F.col(url_col).alias("url"), body.alias("body"),
        F.sha2(body, 256).alias("digest"),
    )
    marks = revisits(pages, id_col=id_col, body_col=body_col).select(F.col("id").alias("r_id"), F.col("digest").alias("r_digest"), "refers_to")
    joined = rows.join(marks, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left")
    records = joined.select(
        "key", F.col("id").cast("string").alias("page"), "url", "body", "digest", F.col("refers_to").cast("string").alias("refers_to"),
    )
    captures = stored(records.mapInArrow(_archive_writer(path), CAPTURE), "captures")
    ordered = captures.repartitionByRange("key", "archive", "offset").sortWithinPartitions("key", "archive", "offset")
    ordered.mapInArrow(_index_writer(path), DIRECTORY).write.parquet(f"{path}/directory")
    return spark.read.schema(DIRECTORY).parquet(f"{path}/directory")


class _Output:
    """A file of the task's own below one archive folder, made when it is first written to."""

    def __init__(self, path: str, ending: str):
        self.path, self.name, self.file, self.at = path, f"{uuid.uuid4().hex}.{ending}", None, 0

    def write(self, data: bytes) -> int:
        """Where the data begins."""
        if self.file is None:
            store, root = _files(self.path)
            store.create_dir(posixpath.join(root, "parts"), recursive=True)
            self.file = store.open_output_stream(posixpath.join(root, "parts", self.name), compression=None)
        self.file.write(data)
        self.at += len(data)
        return self.at - len(data)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _slices(batches: Iterator[pa.RecordBatch], rows: int, sizes: str | None = None) -> Iterator[list[dict]]:
    """Rows of the batches, at most so many at a time; of a column of strings or lengths `sizes`, about `HELD_BYTES` or one row at a time."""
    for batch in batches:
        ends = np.arange(1, len(batch) + 1) * 0
        if sizes is not None:
            column = batch.column(batch.schema.get_field_index(sizes))
            lengths = column if pa.types.is_integer(column.type) else pc.binary_length(column)
            ends = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(np.int64))
        k = 0
        while k < len(batch):
            stop = int(np.searchsorted(ends, (ends[k - 1] if k else 0) + HELD_BYTES, "right"))
            stop = min(k + rows, max(k + 1, stop))
            yield batch.slice(k, stop - k).to_pylist()
            k = stop


def _archive_writer(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = _Output(path, "warc.gz")
        for rows in _slices(batches, 256, "body"):
            captures = []
            for row in rows:
                payload = row["body"].encode("utf-8", "surrogatepass")
                kind = "response" if row["refers_to"] is None else "revisit"
                packed = _gzip(_record(
                    kind, row["page"], row["url"], payload, row["digest"], len(payload), row["refers_to"],
                ))
                captures.append({
                    "key": row["key"], "archive": archive.name, "offset": archive.write(packed), "length": len(packed),
                    "kind": kind, "page": row["page"],
                })
            yield pa.RecordBatch.from_pylist(captures, schema=_arrow(CAPTURE))
        archive.close()

    return run


def _index_writer(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Output(path, "cdx.gz")
        held: list[dict] = []

        def block(rows: list[dict]) -> dict:
            lines = (f"{r['key']} {r['archive']} {r['offset']} {r['length']} {r['kind']} {_urn(r['page'])}\n" for r in rows)
            packed = _gzip("".join(lines).encode("utf-8", "surrogatepass"))
            return {
                "first_key": rows[0]["key"], "last_key": rows[-1]["key"], "index": index.name, "offset": index.write(packed),
                "length": len(packed), "lines": len(rows), "bytes": sum(r["length"] for r in rows),
            }

        for rows in _slices(batches, 4096):
            held += rows
            full = len(held) - len(held) % BLOCK_LINES
            blocks = [block(held[k: k + BLOCK_LINES]) for k in range(0, full, BLOCK_LINES)]
            held = held[full:]
            if blocks:
                yield pa.RecordBatch.from_pylist(blocks, schema=_arrow(DIRECTORY))
        if held:
            yield pa.RecordBatch.from_pylist([block(held)], schema=_arrow(DIRECTORY))
        index.close()

    return run


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])


class _Reader:
    """Range reads below one archive folder; keeps the last file open."""

    def __init__(self, path: str):
        self.store, self.root = _files(path)
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            if self.file:
                self.file.close()
            self.name, self.file = name, self.store.open_input_file(posixpath.join(self.root, "parts", name))
        self.file.seek(offset)
        return self.file.read(length)

    def block(self, row: dict) -> list[tuple[str, str, int, int]]:
        """(key, archive, offset, length) of a block's records, in key order."""
        text = zlib.decompress(self.read(row["index"], row["offset"], row["length"]), 31).decode("utf-8", "surrogatepass")
        return [(f[0], f[1], int(f[2]), int(f[3])) for f in (line.split(" ") for line in text.split("\n") if line)]


ENTRY = "archive string, offset long, length long"
RECORD = "page string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"


def _told(data: bytes) -> dict:
    headers, content = parse_record(zlib.decompress(data, 31))
    kind, digest, size = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:"), int(headers["X-Payload-Length"])
    if kind == "response":
        if hashlib.sha256(content).hexdigest() != digest:
            raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
        size = len(content)
    refers_to = headers.get("WARC-Refers-To")
    return {
        "page": _page(headers["WARC-Record-ID"]), "url": headers.get("WARC-Target-URI"), "payload_bytes": size,
        "payload_digest": digest, "record_type": kind,
        "refers_to": refers_to and _page(refers_to),
        "payload": content if kind == "response" else None,
    }


def read_back(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """Every record of the archives below `path`; a response's digest is checked against what was read."""
    directory = spark.read.schema(DIRECTORY).parquet(f"{path}/directory")
    total = directory.agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    spread = max(1, min(total.n, 4 * spark.sparkContext.defaultParallelism))
    tasks = max(1, total.bytes // READ_BYTES, min(total.n, 4 * spark.sparkContext.defaultParallelism))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(path)
        for rows in _slices(batches, 64):
            found = [{"archive": a, "offset": o, "length": n} for row in rows for _, a, o, n in reader.block(row)]
            yield pa.RecordBatch.from_pylist(found, schema=_arrow(ENTRY))

    return _records(directory.repartition(spread, "index", "offset").mapInArrow(entries, ENTRY), path, int(tasks), payloads)


def _records(found: DataFrame, path: str, tasks: int, payloads: bool) -> DataFrame:
    """The records at the found places, read in archive order."""
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(path)
        for rows in _slices(batches, 256, "length"):
            told = [_told(reader.read(r["archive"], r["offset"], r["length"])) for r in rows]
            if not payloads:
                told = [t | {"payload": None} for t in told]
            yield pa.RecordBatch.from_pylist(told, schema=_arrow(RECORD))

    stripe = (F.col("offset") / READ_BYTES).cast("long")
    dealt = found.repartition(tasks, "archive", stripe).sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(records, RECORD)


def lookup(spark: SparkSession, path: str, urls: DataFrame, *, url_col: str = "url", payloads: bool = True) -> DataFrame:
    """The records of the given URLs, each once; a task takes about `LOOKUP_BYTES` of their keys."""
    directory = spark.read.schema(DIRECTORY).parquet(f"{path}/directory")
    total = directory.agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    spread = max(1, min(total.n, 4 * spark.sparkContext.defaultParallelism))
    tasks = max(1, total.bytes // READ_BYTES, spread)
    keys = stored(urls.select(url_key(url_col).alias("key")).distinct(), "keys")
    size = keys.agg(F.sum(F.octet_length("key") + 64)).first()[0] or 0
    # Keys that lie together are looked for in the same blocks.
    ordered = keys.repartitionByRange(int(min(max(1, -(-size // LOOKUP_BYTES), spread), 10_000)), "key").sortWithinPartitions("key")
    asked = ordered.mapInArrow(_block_finder(path), ASKED)
    placed = asked.repartition(int(spread), "index", "block").sortWithinPartitions("index", "block", "key")
    return _records(placed.mapInArrow(_line_finder(path), ENTRY), path, int(tasks), payloads)


ASKED = "index string, block long, size long, key string"


def _block_finder(path: str):
    """The blocks that may hold each key, by binary search of the directory; a batch of neighbouring keys reads the part of it between them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _files(path)
        columns = ["first_key", "last_key", "index", "offset", "length"]
        folder = pa.fs.FileSelector(posixpath.join(root, "directory"), recursive=False)
        names = [f.path for f in store.get_file_info(folder) if f.base_name.endswith(".parquet")]
        whole = pa.dataset.dataset(names, filesystem=store, format="parquet") if names else pa.dataset.dataset(_arrow(DIRECTORY).empty_table())
        for rows in _slices(batches, 4096):
            low, high = min(r["key"] for r in rows), max(r["key"] for r in rows)
            near = (pc.field("last_key") >= low) & (pc.field("first_key") <= high)
            blocks = whole.to_table(columns=columns, filter=near)
            # Blocks are in key order, so their first keys are and their last keys are; ordered as bytes, as Spark orders strings.
            first, last = ([x.encode("utf-8", "surrogatepass") for x in blocks[c].to_pylist()] for c in columns[:2])
            order = sorted(range(len(first)), key=lambda i: (first[i], last[i]))
            first, last = [first[i] for i in order], [last[i] for i in order]
            index, offset, length = (blocks[c].to_pylist() for c in columns[2:])
            found = []
            for r in rows:
                data = r["key"].encode("utf-8", "surrogatepass")
                for i in order[bisect_left(last, data): bisect_right(first, data)]:
                    found.append({"index": index[i], "block": offset[i], "size": length[i], "key": r["key"]})
            yield pa.RecordBatch.from_pylist(found, schema=_arrow(ASKED))

    return run


def _line_finder(path: str):
    """The places of each key's records, by binary search of a block's lines; a task's rows come block by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, at, lines, names = _Reader(path), None, [], []
        for rows in _slices(batches, 4096):
            found = []
            for r in rows:
                if at != (r["index"], r["block"]):
                    at = r["index"], r["block"]
                    lines = reader.block({"index": r["index"], "offset": r["block"], "length": r["size"]})
                    names = [line[0].encode("utf-8", "surrogatepass") for line in lines]
                key = r["key"].encode("utf-8", "surrogatepass")
                for _, archive, offset, length in lines[bisect_left(names, key): bisect_right(names, key)]:
                    found.append({"archive": archive, "offset": offset, "length": length})
            yield pa.RecordBatch.from_pylist(found, schema=_arrow(ENTRY))

    return run


def checked(looked_up: DataFrame, read: DataFrame) -> DataFrame:
    """The looked up records, stored; an error if they aren't the records of `read`, each as often, payloads aside."""
    rows = stored(looked_up.drop("payload"), "looked-up")
    print_of = [F.count("*").alias("n"), *(
        F.sum(F.shiftrightunsigned(F.xxhash64(F.lit(k), *(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in rows.columns)), 24)).alias(f"h{k}") for k in (1, 2)
    )]
    one, other = rows.agg(*print_of).first(), read.agg(*print_of).first()
    if one != other:
        raise ValueError(f"{one.n} records were found by their URLs, {other.n} by reading all blocks, or they differ")
    return rows

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gradewise.llm import queries, warc
from gradewise.session import scratch_path
from tests.oracle import compare, connect

PAGES = "page_id long, url string, html string, key string, digest string, body string"


@pytest.fixture
def pages(spark):
    long = "<p>" + "é" * 80 + "</p>"
    rows = [
        (5, "http://b.Example.com:80/x?y=1#z", long), (3, "https://user@a.example.com/", long), (9, None, long), (9, None, long),
        (1, "not a url", ""), (2, "http://a.example.com/ \n x", None), (4, "", "short"), (6, "http://a.example.com/", "short"),
        (None, "http://c.org/", long), (3, "https://user@a.example.com/", long), (7, "http://a.example.com/", "x" * 3_000_000),
    ]
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], PAGES)


def told(rows):
    return sorted(((r.page, r.payload_bytes, r.record_type, r.refers_to) for r in rows), key=str)


def test_query_equals_sql(spark, sf):
    rows, problems = compare(queries.op9_warc(spark, sf), connect(sf), queries.oracle_sql()["op9_warc"])
    assert rows and not problems


def test_odd_rows(spark, pages):
    path = scratch_path(spark, "warc")
    warc.write(pages, path)
    rows = warc.read_back(spark, path).collect()
    size = 3 * 2 + 1 + 160
    assert told(rows) == sorted([
        ("5", size, "revisit", "3"), ("3", size, "response", None), ("3", size, "response", None), ("9", size, "revisit", "3"),
        ("9", size, "revisit", "3"), (None, size, "revisit", "3"), ("1", 0, "response", None), ("2", 0, "response", None),
        ("4", 5, "response", None), ("6", 5, "response", None), ("7", 3_000_000, "response", None),
    ], key=str)
    texts = {r.page_id: r.html or "" for r in pages.collect()}
    assert all(bytes(r.payload).decode() == texts[int(r.page)] for r in rows if r.payload is not None)


@pytest.mark.parametrize("lines", [1, 2, 300])
def test_lookup(spark, pages, monkeypatch, lines):
    monkeypatch.setattr(warc, "BLOCK_LINES", lines)
    path = scratch_path(spark, "warc")
    directory = warc.write(pages, path)
    blocks = directory.orderBy("first_key").collect()
    assert sum(b.lines for b in blocks) == 11 and all(a.last_key <= b.first_key for a, b in zip(blocks, blocks[1:]))
    asked = spark.createDataFrame([("https://a.example.com/",), ("http://none.example.com/",), (None,)], "url string")
    assert sorted(r.page for r in warc.lookup(spark, path, asked).collect()) == ["3", "3", "4", "6", "7", "9", "9"]
    for block in (10, 8 << 20):
        monkeypatch.setattr(warc, "LOOKUP_BYTES", block)
        assert warc.lookup(spark, path, asked).count() == 7
    assert warc.lookup(spark, path, asked.limit(0)).count() == 0


def test_query_looks_its_rows_up(spark, sf, monkeypatch):
    asked = []
    lookup = warc.lookup
    monkeypatch.setattr(warc, "lookup", lambda *a, **b: asked.append(a) or lookup(*a, **b))
    assert queries.op9_warc(spark, sf).count() == spark.read.parquet(f"{sf}/pages.parquet").count()
    assert len(asked) == 1


@pytest.mark.parametrize("lines", [1, 2, 300])
def test_lookup_of_all_finds_what_all_blocks_hold(spark, pages, monkeypatch, lines):
    monkeypatch.setattr(warc, "BLOCK_LINES", lines)
    wide = pages.unionByName(pages.withColumn("url", F.concat(F.lit("http://é日😀\uffff.org/"), "page_id")))
    path = scratch_path(spark, "warc")
    warc.write(wide, path)
    read = warc.read_back(spark, path)
    rows = warc.checked(warc.lookup(spark, path, wide), read)
    assert told(rows.collect()) == told(read.collect()) and rows.count() == wide.count()
    with pytest.raises(ValueError, match="by their URLs"):
        warc.checked(warc.lookup(spark, path, wide.where("page_id <> 4")), read)


def test_url_key(spark):
    urls = ["http://www.Example.com/a/b?c=D", "https://u:p@x.y.z:8080", "plain", "", None, "ftp://h/ a"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select(warc.url_key(F.col("url"))).collect()
    assert [r[0] for r in rows] == ["com,example,www)/a/b?c=D", "z,y,x)", "plain", "", "", "h)/%20a"]


def test_nothing(spark, pages):
    path = scratch_path(spark, "warc")
    warc.write(pages.limit(0), path)
    assert warc.read_back(spark, path).count() == 0
    assert warc.lookup(spark, path, pages).count() == 0


def test_damage_is_noticed():
    record = warc._record("response", "1", "http://x/", b"payload", "0" * 64, 7, None)
    with pytest.raises(ValueError, match="damaged"):
        warc._told(warc._gzip(record))


def test_any_page_id(spark):
    """Ids with line breaks, spaces, signs of the formats, or the name of nothing."""
    ids = ["a\nb", "a\r\nWARC-Type: x", "None", "-", "", "<urn:page:1>", "100%41", "ü é", None]
    body = "y" * 200
    rows = [(i, f"http://a.example.com/{k}", body if k % 2 else body + str(k)) for k, i in enumerate(ids)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    path = scratch_path(spark, "warc")
    warc.write(pages, path)
    got = warc.read_back(spark, path).collect()
    first = min(i for i, _, b in rows if i is not None and b == body)
    want = [(i, len(b), "revisit" if b == body and i != first else "response", first if b == body and i != first else None) for i, _, b in rows]
    assert told(got) == sorted(want, key=str)
    assert warc.lookup(spark, path, pages).count() == len(ids)


def test_slices_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "HELD_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"body": ["x" * 4, "x" * 4, "x" * 4, None, "x" * 30, "", "y"], "length": [1] * 7})
    assert [len(s) for s in warc._slices(iter([batch]), 256, "body")] == [2, 2, 1, 2]
    assert [len(s) for s in warc._slices(iter([batch]), 3)] == [3, 3, 1]
    assert [len(s) for s in warc._slices(iter([batch]), 256, "length")] == [7]

"""Insert-only merge."""

from __future__ import annotations

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradewise.operators import merge
from gradewise.session import scratch_path
from gradewise.sources import keys

SCHEMA = "row_hash string, v int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(params=[False, True])
def keys_path(request, spark):
    """None, or a function that gives new paths for the new keys."""
    return (lambda: scratch_path(spark, "keys")) if request.param else (lambda: None)


def test_only_new_keys(spark, keys_path):
    target = frame(spark, [("a", 1), ("a", 2), ("b", 3)])
    batch = frame(spark, [("a", 9), ("c", 4), ("c", 5), ("d", 6), ("d", 6)])
    assert rows(merge.new_rows(batch, target, keys_path=keys_path())) == [("c", 4), ("c", 5), ("d", 6), ("d", 6)]
    once = merge.new_rows(batch, target, dedupe_batch=True, keys_path=keys_path())
    assert rows(once) == [("c", 4), ("d", 6)]


def test_empty_sides(spark, keys_path):
    some, none = frame(spark, [("a", 1), ("b", 2)]), frame(spark, [])
    for target in (none, None):
        assert rows(merge.new_rows(some, target, keys_path=keys_path())) == [("a", 1), ("b", 2)]
    assert rows(merge.new_rows(none, some, keys_path=keys_path())) == []
    assert rows(merge.new_rows(some, some, keys_path=keys_path())) == []
    assert rows(merge.new_rows(frame(spark, [("a", 2), ("a", 1)]), None, dedupe_batch=True)) == [("a", 1)]


keyed = st.lists(st.tuples(st.sampled_from("abcdef"), st.integers(0, 3)), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keyed, keyed, st.booleans())
def test_second_merge_adds_nothing(spark, held, arriving, dedupe):
    target, batch = frame(spark, held), frame(spark, arriving)
    added = merge.new_rows(batch, target, dedupe_batch=dedupe)
    have = {k for k, _ in held}
    expected = [r for r in arriving if r[0] not in have]
    if dedupe:
        expected = [(k, min(v for kk, v in expected if kk == k)) for k in {k for k, _ in expected}]
    assert rows(added) == sorted(expected, key=str)
    after = target.union(added)
    assert rows(merge.new_rows(batch, after, dedupe_batch=dedupe)) == []


def test_dedupe_keeps_column_order_and_nulls(spark):
    batch = spark.createDataFrame([(None, "k", 2), (None, "k", 1), (3, "j", None)], "a int, row_hash string, b int")
    assert rows(merge.one_row_per_key(batch)) == sorted([(None, "k", 1), (3, "j", None)], key=str)


def hashed(spark, first, end):
    return spark.range(first, end).select(F.md5(F.col("id").cast("string")).alias("row_hash"), "id")


def above_scan(plan: str, scan: str) -> list[str]:
    """The operators over a scan, from the scan up to the plan's root."""
    lines = plan.split("\n")
    at = next(i for i, x in enumerate(lines) if scan in x)
    depth = lambda line: len(line) - len(line.lstrip(" :+-|*()0123456789"))
    above, level = [lines[at]], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    return above


def test_only_the_batch_is_exchanged(spark, plan, tmp_path):
    """The target's side is its bucketed keys: neither they nor any other column of the target is exchanged."""
    raw_path = str(tmp_path / "raw")
    target = hashed(spark, 0, 5000)
    held = keys.build_keys(spark, target, raw_path)
    keys.add_keys(spark, hashed(spark, 5000, 6000), raw_path)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in (1, 10_000, 10_000_000):
            text = plan(merge.new_keys(hashed(spark, 4000, 4000 + n), held))
            above = above_scan(text, "gradewise_keys")
            assert "Bucketed: true" in above[0] and "ReadSchema: struct<row_hash:string>" in above[0]
            assert not any("Exchange" in x for x in above)
            assert any("SortMergeJoin" in x and "LeftAnti" in x for x in above)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    again = keys.held_keys(spark, target, raw_path)
    assert again.count() == 6000
    assert merge.new_keys(hashed(spark, 5990, 6010), again).count() == 10


def test_side_table_of_keys(spark, tmp_path):
    raw_path = str(tmp_path / "raw")
    raw = frame(spark, [("a", 1), ("a", 2), (None, 3), ("b", 4)])
    assert rows(keys.held_keys(spark, raw, raw_path)) == [("a",), ("b",)]  # built from the raw table
    keys.add_keys(spark, frame(spark, [("c", 1)]), raw_path)
    more = raw.union(frame(spark, [("c", 5), ("d", 6)]))
    assert rows(keys.held_keys(spark, more, raw_path)) == [("a",), ("b",), ("c",)]  # trusted as it is
    with pytest.raises(RuntimeError):
        with keys.loading(spark, raw_path):
            raise RuntimeError
    assert rows(keys.held_keys(spark, more, raw_path)) == [("a",), ("b",), ("c",), ("d",)]  # built anew after a load that died
    wide = keys.build_keys(spark, more, raw_path, buckets=40)
    assert rows(wide) == [("a",), ("b",), ("c",), ("d",)]
    assert [n for n in os.listdir(keys.key_folder(raw_path)) if n.startswith("v")] == ["v3-40"]


def test_null_keys_are_always_new(spark, keys_path):
    target = frame(spark, [(None, 1), ("a", 1), ("b", 1), ("c", 1)])
    batch = frame(spark, [(None, 2), (None, 3), ("a", 2), ("b", 2), ("z", 2), ("z", 3)])
    assert rows(merge.new_rows(batch, target, keys_path=keys_path())) == sorted(
        [(None, 2), (None, 3), ("z", 2), ("z", 3)], key=str
    )
    once = merge.new_rows(batch, target, dedupe_batch=True, keys_path=keys_path())
    assert rows(once) == sorted([(None, 2), (None, 3), ("z", 2)], key=str)


def test_hot_key_in_batch_and_target(spark):
    """A third of both sides under one key."""
    n = 30_000
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    target = spark.range(n).select(hot.alias("row_hash"), F.lit(0).alias("v"))
    batch = spark.range(n // 2, n + n // 2).select(hot.alias("row_hash"), F.lit(1).alias("v"))
    expected = n // 2 - n // 6
    for path in (None, scratch_path(spark, "keys")):
        assert merge.new_rows(batch, target, keys_path=path).count() == expected
    fresh = merge.new_rows(batch, target.where("row_hash != 'hot'"), dedupe_batch=True)
    assert fresh.count() == expected + 1

"""Sessions over tables equal Spark's own session windows."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradewise.operators import sessions


def built_in(events, gap):
    return events.groupBy(F.session_window("event_time", f"{gap} seconds"), "grade").agg(
        F.count("*").alias("n"), F.sum("loan_amount").alias("v")
    ).select("session_window.start", "session_window.end", "grade", "n", "v")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def events_of(spark, at):
    df = spark.createDataFrame(at, "grade string, micros bigint")
    return df.select("grade", F.timestamp_micros("micros").alias("event_time"), F.lit(1.0).alias("loan_amount"))


@pytest.mark.parametrize("cells", [1, 2, 4096])
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.integers(-60_000_000, 60_000_000)), max_size=40))
def test_random_events(spark, monkeypatch, cells, at):
    monkeypatch.setattr(sessions, "SLICE_CELLS", cells)
    events = events_of(spark, at)
    assert rows(sessions.sessionize(events, gap_seconds=3)) == rows(built_in(events, 3))


def test_exact_gap_joins_and_one_more_splits(spark):
    at = [("A", 0), ("A", 3_000_000), ("A", 6_000_001), ("A", 9_000_002)]
    got = rows(sessions.sessionize(events_of(spark, at), gap_seconds=3))
    assert [r[3] for r in got] == [2, 1, 1]


def test_long_chain_across_slices(spark, monkeypatch):
    monkeypatch.setattr(sessions, "SLICE_CELLS", 4)
    chain = [("A", i * 2_000_000) for i in range(200)]
    lone = [("A", 1_000_000_000), ("B", 5)]
    got = rows(sessions.sessionize(events_of(spark, chain + lone), gap_seconds=3))
    assert sorted(r[3] for r in got) == [1, 1, 200]


def test_events_are_reduced_before_the_shuffle(spark, sf, plan):
    from gradewise import fixtures

    text = plan(sessions.sessionize(fixtures.loan_events(spark, sf)))
    first_exchange = text.rindex("Exchange hashpartitioning")
    assert "partial_count" in text[first_exchange:]


def test_delinquency_filter_reaches_the_scan(spark, sf, tmp_path, plan):
    from gradewise import fixtures
    from gradewise.streaming import windows

    path = str(tmp_path / "events")
    fixtures.loan_events(spark, sf).write.parquet(path)
    pushed = plan(windows.delinquency_sessions(spark.read.parquet(path))).split("PushedFilters: ")[1]
    assert "Or(In(loan_status" in pushed and "GreaterThan(mths_since_last_delinq,0)" in pushed
    assert "user" not in pushed and "interest_rate" not in pushed


def test_hot_grade(spark):
    """One grade with most of the events, many at the same instant."""
    n = 20_000
    events = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.lit("B")).otherwise(F.lit("A")).alias("grade"),
        F.timestamp_seconds(F.floor(F.col("id") / 50) * 400 + F.col("id") % 7).alias("event_time"),
        F.lit(1.0).alias("loan_amount"),
    )
    assert rows(sessions.sessionize(events)) == rows(built_in(events, 300))

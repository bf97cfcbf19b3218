"""Streams equal tables on closed windows; late data, restarts, redelivery, idle topics."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from gradewise import fixtures
from gradewise.schemas import EVENT_SCHEMA
from gradewise.session import scratch_path, stream_session
from gradewise.streaming import counter, sinks, windows
from gradewise.streaming.runner import late_figures, late_rows, start_query

COLUMNS = "loan_id string, grade string, loan_amount double, interest_rate double, loan_status string, " \
          "mths_since_last_delinq int, event_time timestamp"


@pytest.fixture(scope="module")
def streams(spark):
    return stream_session(spark, state_partitions=2)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


class Feed:
    """A folder of event files that are read one per micro-batch, in the order written."""

    def __init__(self, spark, streams, path, schema=COLUMNS):
        self.spark, self.streams, self.path, self.schema = spark, streams, str(path), schema
        self.n = 0

    def add(self, df):
        df.coalesce(1).write.mode("append").parquet(f"{self.path}/{self.n:03d}")
        self.n += 1
        time.sleep(1.1)  # files are taken by modification time, in seconds on some file systems

    def stream(self):
        return self.streams.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.path}/*")


def run(results, out, checkpoint, mode="append"):
    start_query(results, out, checkpoint, mode, available_now=True).awaitTermination()


def at(spark, *events):
    """Events (grade, amount, second of the day)."""
    start = dt.datetime(2024, 1, 1)
    data = [("x", g, float(a), 5.0, "Default", None, start + dt.timedelta(seconds=s)) for g, a, s in events]
    return spark.createDataFrame(data, COLUMNS)


def test_many_batches_equal_one_table(spark, streams, sf, tmp_path):
    table = fixtures.loan_events(spark, sf).select(*[c.split()[0] for c in COLUMNS.split(", ")])
    feed = Feed(spark, streams, tmp_path / "in")
    for first, last in ((1, 10), (11, 20), (21, 31)):
        feed.add(table.where(F.dayofmonth("event_time").between(first, last)))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    results = windows.tumbling_by_grade(feed.stream(), delay="1 minute")
    run(results, out, checkpoint)
    got = spark.read.schema(results.schema).parquet(out)
    limit = table.agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=1)
    expected = windows.tumbling_by_grade(table).where(F.col("window_end") <= F.lit(limit))
    assert rows(got) == rows(expected)

    run(windows.tumbling_by_grade(feed.stream(), delay="1 minute"), out, checkpoint)  # restart: nothing new
    assert spark.read.schema(results.schema).parquet(out).count() == expected.count()


def test_sessions_over_batches(spark, streams, tmp_path):
    feed = Feed(spark, streams, tmp_path / "in")
    feed.add(at(spark, ("A", 1, 0), ("A", 2, 200), ("B", 4, 100)))
    feed.add(at(spark, ("A", 8, 500), ("B", 16, 401)))
    feed.add(at(spark, ("C", 32, 5000)))
    results = windows.delinquency_sessions(feed.stream(), delay="0 seconds")
    run(results, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = spark.read.schema(results.schema).parquet(str(tmp_path / "out"))
    assert sorted(tuple(r)[2:] for r in got.collect()) == [("A", 3, 11.0), ("B", 1, 4.0), ("B", 1, 16.0)]
    first = got.where("grade = 'A'").first()
    assert (first["session_end"] - first["session_start"]).total_seconds() == 800


def test_late_events(spark, streams, tmp_path):
    """Events are judged by the watermark the batch before worked with, two batches behind them."""
    feed = Feed(spark, streams, tmp_path / "in")
    feed.add(at(spark, ("A", 1, 10_000)))
    feed.add(at(spark, ("A", 2, 20_000), ("A", 4, 9_999)))
    feed.add(at(spark, ("A", 8, 10_001), ("A", 16, 30_000)))
    feed.add(at(spark, ("A", 32, 10_002), ("A", 64, 40_000)))
    results = windows.tumbling_by_grade(feed.stream(), delay="1 minute")
    query = start_query(results, str(tmp_path / "out"), str(tmp_path / "checkpoint"), available_now=True)
    query.awaitTermination()
    got = spark.read.schema(results.schema).parquet(str(tmp_path / "out"))
    assert sorted(r["total_volume"] for r in got.collect()) == [2.0, 13.0, 16.0]
    assert late_rows(query) == 1


def test_late_rows_of_more_batches_than_spark_reports(spark, tmp_path):
    """The first and the last of 112 batches drop rows, and 40 in between; a query's own list holds the last 100."""
    source, n = tmp_path / "in", 112
    source.mkdir()
    late = {0: 0, 1: 3, n - 1: 2} | {k: 1 for k in range(2, 82, 2)}
    for k in range(n):
        moment = lambda s: (dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)).isoformat()
        rows_ = [("A", moment(100_000 + 1000 * k))] + [(f"late{i}", moment(10 + i)) for i in range(late.get(k, 0))]
        (source / f"{k:04d}.csv").write_text("".join(f"{g},{t}\n" for g, t in rows_))
        os.utime(source / f"{k:04d}.csv", (10**9 + k, 10**9 + k))
    events = stream_session(spark, 1).readStream.schema("grade string, event_time timestamp").option("maxFilesPerTrigger", 1).csv(str(source))
    events = events.withColumns({"loan_amount": F.lit(1.0), "interest_rate": F.lit(1.0)})
    figures = str(tmp_path / "late")
    query = start_query(
        windows.tumbling_by_grade(events, delay="0 seconds"), lambda batch, _: batch.write.format("noop").mode("overwrite").save(), str(tmp_path / "c"), "append", available_now=True, late_path=figures,
    )
    query.awaitTermination()
    assert len(query.recentProgress) <= 100 < n
    assert late_rows(query) == sum(late.values())
    told = {r["batch_id"]: r["dropped"] for r in late_figures(spark, figures).collect()}
    assert sorted(told.values()) == sorted(x for x in late.values() if x) and min(told) < 5
    assert late_figures(spark, str(tmp_path / "none")).count() == 0


def test_event_time_needs_a_delay(spark, streams, sf):
    stream = fixtures.loan_event_stream(streams, sf)
    for window in (windows.tumbling_by_grade, windows.delinquency_sessions):
        with pytest.raises(ValueError, match="delay"):
            window(stream)
        window(windows.with_processing_time(stream))


def test_snapshots_are_bounded(spark, tmp_path):
    write = sinks.snapshot_batches(str(tmp_path / "s"), keep=2)
    for n in range(6):
        write(spark.range(n), n)
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.name.startswith("batch")) == ["batch_id=4", "batch_id=5"]
    assert sinks.newest(spark, str(tmp_path / "s")).count() == 5


def test_state_partitions_follow_the_session(spark):
    assert stream_session(spark).conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert stream_session(spark, 3).conf.get("spark.sql.shuffle.partitions") == "3"


def test_update_mode_shows_open_windows(spark, streams, tmp_path):
    feed = Feed(spark, streams, tmp_path / "in")
    feed.add(at(spark, ("A", 1, 0), ("B", 2, 10)))
    feed.add(at(spark, ("A", 4, 20)))
    results = windows.tumbling_by_grade(feed.stream(), delay="0 seconds")
    out = str(tmp_path / "out")
    run(results, sinks.parquet_batches(out), str(tmp_path / "checkpoint"), "update")
    current = sinks.latest(spark.read.parquet(out), "window_start", "grade")
    assert sorted((r["grade"], r["total_loans"], r["total_volume"]) for r in current.collect()) == [
        ("A", 2, 5.0), ("B", 1, 2.0),
    ]


def test_counter_reports_per_batch(spark, streams, tmp_path):
    schema = EVENT_SCHEMA
    feed = Feed(spark, streams, tmp_path / "in", schema)
    one = [("1", "A", 1.0, 1.0, "Current", None, 3, 1.0, 1.0, "Low Risk"),
           ("2", None, 1.0, 1.0, "Current", None, None, 1.0, 1.0, "Unknown")]
    two = [("3", "A", 1.0, 1.0, "Current", None, 0, 1.0, 1.0, "Low Risk")]
    for part in (one, two):
        feed.add(spark.createDataFrame(part, schema))
    out = str(tmp_path / "out")
    run(counter.delinquency_by_grade(feed.stream()), sinks.parquet_batches(out), str(tmp_path / "c"), "complete")
    history = spark.read.parquet(out)
    assert sorted(r["batch_id"] for r in history.select("batch_id").distinct().collect()) == [0, 1]
    current = sinks.latest(history, "grade")
    assert rows(current) == [("A", 2, 1), ("Unknown", 1, 0)]
    assert rows(counter.delinquency_totals(current)) == [(3, 1, 33.3)]
    assert rows(counter.delinquency_totals(current.limit(0))) == [(0, 0, 0.0)]


def messages(spark, n, first=0):
    """Messages first, first + 1, ...: every third delinquent, grades A, B, C and none in turn."""
    i = F.col("id")
    return spark.range(first, first + n).select(
        F.lpad(i.cast("string"), 9, "0").alias("loan_id"), F.when(i % 4 < 3, F.substring(F.lit("ABC"), (i % 4 + 1).cast("int"), F.lit(1))).alias("grade"),
        F.when(i % 3 == 0, 5).otherwise(0).alias("mths_since_last_delinq"),
    )


def plain_reports(n, every):
    out = []
    for end in range(every, n + 1, every):
        grades = {}
        for i in range(end):
            grades[("A", "B", "C", "Unknown")[i % 4]] = grades.get(("A", "B", "C", "Unknown")[i % 4], 0) + 1
        bad = len(range(0, end, 3))
        out.append((end, bad, round(bad / end * 100 + 1e-12, 1), grades))
    return out


def told_reports(spark, path):
    return sorted(((r.total_loans, r.delinquent_loans, r.delinquency_rate_pct, r.by_grade) for r in counter.reports(spark, path).collect()), key=lambda r: r[0])


def test_counter_reports_by_message_count(spark, tmp_path):
    """Batches of any size, some without a report and one delivered twice; the counts go on where they were."""
    path = str(tmp_path / "counter")
    write = counter.reports_every(path, every=7, order=("loan_id",))
    done = 0
    for batch, n in enumerate([3, 0, 40, 1, 5, 14]):
        for _ in range(2 if batch == 2 else 1):
            write(messages(spark, n, done).repartition(3), batch)
        done += n
        assert told_reports(spark, path) == plain_reports(done, 7)
        assert counter.totals(spark, path).agg(F.sum("total_loans")).first()[0] == (done or None)
    assert len([x for x in os.listdir(f"{path}/totals") if x.startswith("batch_id")]) == 3


def test_counter_reports_on_a_folder(spark, streams, tmp_path):
    messages(spark, 1234).write.parquet(str(tmp_path / "in"))
    events = streams.readStream.schema("loan_id string, grade string, mths_since_last_delinq int").option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    run(events, counter.reports_every(out, 500), str(tmp_path / "c"))
    told = told_reports(spark, out)
    assert [r[0] for r in told] == [500, 1000] and [sum(r[3].values()) for r in told] == [500, 1000]
    assert rows(counter.delinquency_totals(counter.totals(spark, out))) == [(1234, 412, 33.4)]


def test_redelivered_batch_replaces_itself(spark, tmp_path):
    write = sinks.parquet_batches(str(tmp_path))
    write(spark.range(3), 0)
    write(spark.range(4), 1)
    write(spark.range(4), 1)
    assert spark.read.parquet(str(tmp_path)).count() == 7


def test_jdbc_writer_stamps_rows(spark, monkeypatch):
    """Only the call is checked: running it takes a database."""
    calls = []
    frame = spark.range(3)

    def jdbc(self, url, table, mode, properties):
        calls.append((self._df.columns, self._df.first()["batch_id"], url, table, mode, properties))

    monkeypatch.setattr(type(frame.write), "jdbc", jdbc)
    sinks.jdbc_batches("jdbc:x", "t", {"user": "u"})(frame, 7)
    assert calls == [(["id", "batch_id"], 7, "jdbc:x", "t", "append", {"user": "u"})]


def test_jdbc_writer_fits_declared_columns(spark, monkeypatch):
    calls = []
    frame = spark.range(3)
    monkeypatch.setattr(type(frame.write), "jdbc", lambda self, *a, **k: calls.append(self._df.columns))
    sinks.jdbc_batches("jdbc:x", "t", batch_column=None)(frame, 7)
    assert calls == [["id"]]


def test_idle_topic_closes_by_the_clock(spark, streams, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame(
        [("1", "A", 10.0, 5.0, "Default", None, 3, 1.0, 1.0, "Low Risk"),
         ("2", None, 20.0, 6.0, "Default", None, 3, 1.0, 1.0, "Unknown"),
         ("3", "A", 40.0, 7.0, "Current", None, 0, 1.0, 1.0, "Low Risk")], EVENT_SCHEMA,
    ).coalesce(1).write.json(source)
    events = streams.readStream.schema(EVENT_SCHEMA).json(source)
    mixed = windows.with_processing_time(windows.with_ticks(events))
    started = {
        "fixed": windows.tumbling_by_grade(mixed, size="2 seconds"),
        "sessions": windows.delinquency_sessions(mixed, gap_seconds=2),
    }
    running = {
        name: start_query(df, str(tmp_path / name), str(tmp_path / f"{name}-c"), interval="1 second")
        for name, df in started.items()
    }
    try:
        deadline = time.time() + 60
        got = {}
        while time.time() < deadline and len(got) < 2:
            time.sleep(1)
            for name, df in started.items():
                if (tmp_path / name / "_spark_metadata").exists():
                    found = rows(spark.read.schema(df.schema).parquet(str(tmp_path / name)).drop(
                        "window_start", "window_end", "session_start", "session_end"))
                    if found:
                        got[name] = found
    finally:
        for query in running.values():
            query.stop()
    assert got["fixed"] == [("A", 2, 50.0, 6.0), (None, 1, 20.0, 6.0)]
    assert got["sessions"] == [("A", 1, 10.0), (None, 1, 20.0)]


def test_local_merge_before_the_session_shuffle(spark, streams, sf, tmp_path):
    """Sessions are merged inside map tasks, so a hot grade does not ship single events."""
    results = windows.delinquency_sessions(fixtures.loan_event_stream(streams, sf), delay="0 seconds")
    query = start_query(results, str(tmp_path / "out"), scratch_path(spark, "c"), available_now=True)
    query.awaitTermination()
    text = query._jsq.explainInternal(False)
    before_shuffle = text[text.index("Exchange hashpartitioning"):]
    assert "MergingSessions" in before_shuffle

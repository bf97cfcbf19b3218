"""Windows over loan events. Each function takes a stream or a table of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewise.functions import is_delinquent_event, round_stable
from gradewise.operators.sessions import sessionize

# Marks rows that only move the clock (see with_ticks).
TICK = "_tick"
# In a column's metadata: its times come from the clock, so none of them is ever late.
CLOCKED = "processing_time"


def with_processing_time(events: DataFrame, name: str = "event_time") -> DataFrame:
    """Stamp events with the time they are processed: the start of their micro-batch."""
    stamped = events.withColumn(name, F.current_timestamp())
    return stamped.withMetadata(name, {CLOCKED: True})


def clock(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """An endless stream of ticks."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return rate.select(F.lit(True).alias(TICK))


def with_ticks(events: DataFrame, ticks: DataFrame | None = None) -> DataFrame:
    """Mix ticks into an event stream, so that time goes on while no events come in.

    Spark closes windows only when later rows arrive. Windows over processing time should
    close by the clock, also on a topic that has gone quiet: stamp the mixed stream with
    with_processing_time. The window functions count no ticks and report none.
    """
    ticks = clock(events.sparkSession) if ticks is None else ticks
    return events.withColumn(TICK, F.lit(False)).unionByName(ticks, allowMissingColumns=True)


def _keys(events: DataFrame) -> list[str]:
    return ["grade", TICK] if TICK in events.columns else ["grade"]


def _count(events: DataFrame) -> Column:
    return F.count_if(~F.col(TICK)) if TICK in events.columns else F.count("*")


def _drop_ticks(windows: DataFrame, source: DataFrame, count: str) -> DataFrame:
    # By the counted value: a filter on the key would be pushed below the watermark and
    # take the ticks out before they moved it.
    return windows.where(F.col(count) > 0) if TICK in source.columns else windows


def _watermarked(events: DataFrame, ts: str, delay: str | None) -> DataFrame:
    if not events.isStreaming:
        return events
    if delay is None:
        if not events.schema[ts].metadata.get(CLOCKED):
            raise ValueError(f"say how late {ts} may be (delay): events later than that are dropped")
        delay = "0 seconds"
    return events.withWatermark(ts, delay)


def tumbling_by_grade(
    events: DataFrame, ts: str = "event_time", size: str = "5 minutes", delay: str | None = None
) -> DataFrame:
    """Loans, volume and mean interest rate per grade and fixed window.

    On a stream, append mode gives a window once the watermark (latest event minus
    `delay`) passes its end; update mode gives every window as it changes. Events of a window
    that the watermark has passed are dropped (`runner.late_rows` counts them), so a stream over
    event time must name its `delay`; times from the clock are never late and need none.
    """
    by_window = _watermarked(events, ts, delay).groupBy(F.window(ts, size), *_keys(events))
    windows = by_window.agg(
        _count(events).alias("total_loans"),
        F.sum("loan_amount").alias("total_volume"),
        round_stable(F.avg("interest_rate"), 2).alias("avg_interest"),
    )
    return _drop_ticks(windows, events, "total_loans").select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "grade", "total_loans", "total_volume", "avg_interest",
    )


def delinquent_events(events: DataFrame) -> DataFrame:
    """Events of defaulted or once delinquent loans (and ticks, if mixed in)."""
    wanted = is_delinquent_event(F.col("loan_status"), F.col("mths_since_last_delinq"))
    if TICK in events.columns:
        wanted = wanted | F.col(TICK)
    return events.where(wanted)


def delinquency_sessions(
    events: DataFrame, ts: str = "event_time", gap_seconds: int = 300, delay: str | None = None
) -> DataFrame:
    """Sessions of delinquent events per grade; a session ends one gap after its last event.

    On a stream, append mode gives a session once the watermark passes its end, and drops late
    events as `tumbling_by_grade` does. Complete mode gives all sessions, open ones too, and
    drops nothing; its state keeps every session, so it suits runs that end. The watermark follows the
    delinquent events, not all events.
    """
    wanted = delinquent_events(events)
    if not events.isStreaming:
        return sessionize(wanted, ts, gap_seconds)
    by_session = _watermarked(wanted, ts, delay).groupBy(
        F.session_window(ts, f"{gap_seconds} seconds"), *_keys(events)
    )
    sessions = by_session.agg(
        _count(events).alias("events_in_session"), F.sum("loan_amount").alias("total_volume")
    )
    return _drop_ticks(sessions, events, "events_in_session").select(
        F.col("session_window.start").alias("session_start"),
        F.col("session_window.end").alias("session_end"),
        "grade", "events_in_session", "total_volume",
    )

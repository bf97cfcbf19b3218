"""Sessions of delinquent events over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Cells of one gap length that a window task works through at a time.
SLICE_CELLS = 4096


def sessionize(
    events: DataFrame, ts: str = "event_time", gap_seconds: int = 300, key: str = "grade",
    amount: str = "loan_amount",
) -> DataFrame:
    """Sessions per key: events at most `gap_seconds` apart belong together.

    Same result as grouping by `session_window`, which sends all events of a key to one
    task. Here time is cut into cells as long as the gap. Events of one cell are always in
    the same session, so they are reduced to one row by a hash aggregate before the first
    shuffle, and what is left grows with the time covered, not with the events. Cells are
    chained to sessions within slices of SLICE_CELLS; only the first and last session of a
    slice can go on in another one, so only those meet again per key.
    """
    gap = gap_seconds * 1_000_000
    micros = F.unix_micros(F.col(ts))
    cells = (
        events.where(F.col(ts).isNotNull())
        .select(F.col(key), micros.alias("at"), F.col(amount).alias("amount"))
        .withColumn("cell", _start_of(F.col("at"), gap))
        .groupBy(key, "cell")
        .agg(
            F.min("at").alias("first_at"), F.max("at").alias("last_at"),
            F.count("*").alias("events"), F.sum("amount").alias("volume"),
        )
        .withColumn("slice", _start_of(F.col("cell"), gap * SLICE_CELLS))
    )
    local = _chain(cells, [key, "slice"], gap)
    in_slice = Window.partitionBy(key, "slice")
    # Sessions inside a slice are final and stay in it; the edge ones go to the key's own
    # group, of which there are at most two per slice.
    placed = local.withColumn(
        "place",
        F.when(
            (F.col("number") > F.min("number").over(in_slice))
            & (F.col("number") < F.max("number").over(in_slice)),
            F.col("slice"),
        ),
    )
    return _chain(placed, [key, "place"], gap).select(
        F.timestamp_micros("first_at").alias("session_start"),
        F.timestamp_micros(F.col("last_at") + gap).alias("session_end"),
        key,
        F.col("events").alias("events_in_session"),
        F.col("volume").alias("total_volume"),
    )


def _start_of(micros: Column, width: int) -> Column:
    return micros - F.pmod(micros, F.lit(width))


def _chain(spans: DataFrame, group: list[str], gap: int) -> DataFrame:
    """Join spans of a group that follow each other by at most the gap."""
    in_order = Window.partitionBy(*group).orderBy("first_at")
    starts_new = F.col("first_at") - F.lag("last_at").over(in_order) > gap
    numbered = spans.withColumn("starts", F.coalesce(starts_new, F.lit(False)).cast("int"))
    numbered = numbered.withColumn("number", F.sum("starts").over(in_order))
    return numbered.groupBy(*group, "number").agg(
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"),
        F.sum("events").alias("events"), F.sum("volume").alias("volume"),
    )

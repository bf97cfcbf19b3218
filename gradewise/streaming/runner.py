"""Starting streaming queries."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from gradewise.session import path_exists, write_text
from gradewise.streaming.sinks import BatchWriter

FIGURES = "query string, run string, batch_id bigint, dropped bigint, watermark string"


class LateRows(StreamingQueryListener):
    """Counts the rows that the watermark dropped, from a query's first batch to its last.

    They are counted where Spark drops them, behind its sums: late events of one window and grade in one batch are one row there.

    A query's own list of reports holds the last hundred only. Each batch that dropped rows is also written to `path`, if given, one small
    file a batch, so the figures outlive the driver (`late_figures` reads them). A listener hears of all queries of its session; this one
    keeps those of the run that it is told to `follow`.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self._spark, self._path = spark, path
        self._lock = threading.Lock()
        self._totals: dict[str, int] = {}
        self._last: dict[str, tuple[int, int]] = {}
        self._ended: set[str] = set()
        self._run: str | None = None
        self._over = threading.Event()

    def follow(self, query: StreamingQuery) -> None:
        with self._lock:
            self._run = str(query.runId)
            for held in (self._totals, self._last):
                for run in [r for r in held if r != self._run]:
                    del held[run]
            if self._run in self._ended:
                self._over.set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        run, batch = str(progress.runId), progress.batchId
        with self._lock:
            if self._run not in (None, run):
                return
            dropped = sum(max(0, operator.numRowsDroppedByWatermark) for operator in progress.stateOperators)
            last, counted = self._last.get(run, (-1, 0))
            # A batch may be told of again.
            fresh = max(0, dropped - counted) if batch == last else dropped
            self._last[run] = (batch, max(dropped, counted) if batch == last else dropped)
            self._totals[run] = self._totals.get(run, 0) + fresh
        if fresh and self._path:
            row = {"query": str(progress.id), "run": run, "batch_id": batch, "dropped": dropped, "watermark": progress.eventTime.get("watermark")}
            write_text(self._spark, f"{self._path.rstrip('/')}/{run}-{batch}.json", json.dumps(row) + "\n")

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            if str(event.runId) == self._run:
                self._over.set()
                self._spark.streams.removeListener(self)

    def total(self, query: StreamingQuery, wait_seconds: float = 30) -> int:
        """Rows dropped so far; of a query that has ended, in all of its batches."""
        if not query.isActive:
            # Reports come on a thread of their own, the last one before the end.
            self._over.wait(wait_seconds)
        with self._lock:
            return self._totals.get(str(query.runId), 0)


_watches: dict[str, LateRows] = {}


def start_query(
    results: DataFrame,
    sink: str | BatchWriter,
    checkpoint: str,
    output_mode: str = "append",
    interval: str = "10 seconds",
    available_now: bool = False,
    name: str | None = None,
    late_path: str | None = None,
) -> StreamingQuery:
    """Start a continuous insert of `results` into a sink.

    `sink` is a folder for Spark's own exactly-once Parquet sink (append mode only), or a
    writer of batches. Every query needs a checkpoint folder of its own: it holds the
    offsets, so that queries on one topic read independently, and the state.
    `available_now` works off what is there and stops. Rows that the watermark drops are counted from the start (`late_rows`),
    and for each batch in the folder `late_path`, if given.
    """
    spark = results.sparkSession
    watch = LateRows(spark, late_path)
    spark.streams.addListener(watch)
    writer = results.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    try:
        query = writer.format("parquet").option("path", sink).start() if isinstance(sink, str) else writer.foreachBatch(sink).start()
    except BaseException:
        spark.streams.removeListener(watch)
        raise
    watch.follow(query)
    _watches[str(query.runId)] = watch
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark dropped since `start_query` started this run."""
    return _watches[str(query.runId)].total(query)


def late_figures(spark: SparkSession, late_path: str) -> DataFrame:
    """The batches that dropped rows, of all runs that wrote to the folder: query, run, batch_id, dropped, watermark."""
    if not path_exists(spark, late_path):
        return spark.createDataFrame([], FIGURES)
    return spark.read.schema(FIGURES).json(late_path)

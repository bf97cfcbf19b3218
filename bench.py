"""Bench: the headline jobs over loans of the size of `$BENCH_SF_DIR`, on `local[$BENCH_CPUS]`.

The loans are stored once as a month-partitioned raw table and as a plain loan file, which is
what the jobs read in earnest; storing them is not timed. Every query runs once unmeasured
and then three times; the median counts. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame

from gradewise import fixtures
from gradewise.operators import merge, quality, reports
from gradewise.plans import models
from gradewise.plans.ingest import ingest
from gradewise.plans.report import run_report
from gradewise.session import build_session, scratch_path, stream_session
from gradewise.sources import events as event_source
from gradewise.sources import files
from gradewise.sources.keys import held_keys
from gradewise.streaming import counter, windows
from gradewise.streaming.runner import start_query

RUNS = 3


def work(df: DataFrame) -> None:
    """Compute all of a result without bringing it to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__log__level="ERROR",
        spark__checkpoint__dir=shared,
    )
    loan_path, raw_path = scratch_path(spark, "loans"), scratch_path(spark, "raw")
    fixtures.loans(spark, sf).drop("k").write.parquet(loan_path)
    files.write_raw(fixtures.raw_loans(spark, sf), raw_path)
    events_path = scratch_path(spark, "events")
    fixtures.loan_events(spark, sf).write.parquet(events_path)
    csv_path = scratch_path(spark, "csv")
    fixtures.csv_loans(spark, sf).write.option("header", True).csv(csv_path)

    loans, raw = spark.read.parquet(loan_path), files.read_raw(spark, raw_path)
    loan_events = spark.read.parquet(events_path)
    staged = models.stg_loans(raw)
    rows, n_events = raw.count(), loan_events.count()

    def drain(results: DataFrame, output_mode: str = "append") -> None:
        def sink(batch: DataFrame, _: int) -> None:
            work(batch)

        checkpoint = scratch_path(spark, "checkpoint")
        start_query(results, sink, checkpoint, output_mode, available_now=True).awaitTermination()

    def stream() -> DataFrame:
        return stream_session(spark).readStream.schema(loan_events.schema).parquet(events_path)

    def ingest_csv() -> None:
        ingest(spark, csv_path, scratch_path(spark, "ingested"), one_line_per_record=True)

    queries = {
        "default_rate_by_grade": lambda: work(reports.default_rate_by_grade(loans)),
        "monthly_volume": lambda: work(reports.monthly_volume(loans)),
        "dpd_distribution": lambda: work(reports.dpd_distribution(loans)),
        "risk_tier_summary": lambda: work(reports.risk_tier_summary(loans)),
        "batch_report": lambda: run_report(spark, loan_path, scratch_path(spark, "report")),
        "fct_loans": lambda: work(models.fct_loans(staged)),
        "mart_loan_risk": lambda: work(models.mart_loan_risk(models.fct_loans(staged))),
        "dq_report": lambda: work(quality.run_checks(staged)),
        "merge_rerun": lambda: work(merge.new_rows(raw, raw)),
        "merge_rerun_side_table": lambda: work(merge.new_rows(raw, held_keys(spark, raw, raw_path), keys_path=scratch_path(spark, "keys"))),
        "merge_first_load": lambda: work(merge.new_rows(raw, None, dedupe_batch=True)),
        "ingest_csv": ingest_csv,
        "ingest_csv_default": lambda: ingest(spark, csv_path, scratch_path(spark, "ingested")),
        "publish_parse": lambda: work(event_source.parse_events(event_source.to_events(staged))),
        "tumbling_window_all": lambda: work(windows.tumbling_by_grade(loan_events)),
        "session_window_all": lambda: work(windows.delinquency_sessions(loan_events)),
        "tumbling_window": lambda: drain(windows.tumbling_by_grade(stream(), delay="1 minute")),
        "session_window": lambda: drain(windows.delinquency_sessions(stream(), delay="1 minute")),
        "delinquency_by_grade": lambda: drain(counter.delinquency_by_grade(stream()), "complete"),
    }
    wanted = sys.argv[1:] or list(queries)
    seconds = {}
    for name in wanted:
        queries[name]()
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            queries[name]()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    print(json.dumps({
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
        "rows": {"loans": rows, "events": n_events},
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()

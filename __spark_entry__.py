"""

Queries read the driver's tables through `gradewise.fixtures`, which turns `orders` and
`customer` into loans and `events` into loan events. `oracle_sql` builds the same inputs in
SQL and computes each result independently.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradewise import fixtures
from gradewise.functions import (
    default_flag,
    dpd_bucket,
    parse_issue_month,
    percent_to_double,
    risk_tier,
    round_stable,
    row_hash,
)
from gradewise.operators import merge, quality, reports
from gradewise.plans import dashboard, models, refresh
from gradewise.plans.ingest import ingest, ingest_new_files, merge_into_raw
from gradewise.plans.report import add_load, run_report
from gradewise.schemas import RAW_SCHEMA, SOURCE_COLUMNS
from gradewise.session import scratch_path, stream_session
from gradewise.sources import events as event_source
from gradewise.sources import files, tables
from gradewise.streaming import counter, sinks, windows
from gradewise.streaming.runner import late_figures, late_rows, start_query

try:
    from gradewise.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    # The subpackage and the pipeline over it may be left out; anything else that is missing is an error.
    if missing.name not in ("gradewise.llm", "corpus_pipeline"):
        raise
    llm_queries = None

ENTRY_DIR = "/root/testdata/sf0.001"

# Loans loaded before this day are "already in the raw table" in the merge queries.
LOADED_BEFORE = dt.datetime(1998, 1, 1)
LOADS = ("2024-01-02 03:04:05", "2024-02-03 04:05:06")
ISSUED = (dt.date(1996, 3, 1), dt.date(1997, 10, 31))
DELAY = "1 minute"
SESSION_GAP = 1800
PUBLISH_LIMIT = 5000
REPORT_EVERY = 500
LATE_DAYS = ((20, 24), (25, 31), (1, 4))


def entry(spark: SparkSession) -> DataFrame:
    """Default rate by grade over the smallest tables."""
    return reports.default_rate_by_grade(fixtures.loans(spark, ENTRY_DIR))


# --- inputs ------------------------------------------------------------------------


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    return models.stg_loans(fixtures.raw_loans(spark, sf))


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    return models.fct_loans(_staged(spark, sf))


def _mart(spark: SparkSession, sf: str) -> DataFrame:
    return models.mart_loan_risk(_facts(spark, sf))


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps without a zone, the form the test tables and DuckDB use."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _cents(df: DataFrame, column: str) -> DataFrame:
    """A plain sum of doubles to the cent: its last bits depend on the order of rows."""
    return df.withColumn(column, round_stable(F.col(column), 2))


# --- scans and column rules --------------------------------------------------------


def scan_loans(spark, sf):
    return fixtures.loans(spark, sf).drop("k")


def external_view(spark, sf):
    return tables.external_view(spark, f"{sf}/customer.parquet", "gradewise_customer_ext")


def row_count(spark, sf):
    return reports.row_count(fixtures.loans(spark, sf))


def clean_rate(spark, sf):
    return fixtures.loans(spark, sf).select("k", percent_to_double(F.col("int_rate")).alias("int_rate"))


def default_flags(spark, sf):
    status = F.col("loan_status")
    return fixtures.loans(spark, sf).select(
        "k", "loan_status",
        default_flag(status).cast("int").alias("is_defaulted"),
        default_flag(status, case_sensitive=True).alias("is_defaulted_exact"),
    )


def risk_tiers(spark, sf):
    return fixtures.loans(spark, sf).select("k", "grade", risk_tier(F.col("grade")).alias("risk_tier"))


def dpd_buckets(spark, sf):
    months = F.col("mths_since_last_delinq")
    return fixtures.loans(spark, sf).select("k", months, dpd_bucket(months).alias("dpd_bucket"))


def parse_issue_date(spark, sf):
    return fixtures.loans(spark, sf).select("k", "issue_d", parse_issue_month(F.col("issue_d")).alias("issue_date"))


def row_hashes(spark, sf):
    return fixtures.loans(spark, sf).select("k", row_hash(F.col("id")).alias("row_hash"))


def raw_schema(spark, sf):
    return _ntz(fixtures.raw_loans(spark, sf), "ingest_ts")


# --- models ------------------------------------------------------------------------


def stg_loans(spark, sf):
    return _ntz(_staged(spark, sf), "ingest_ts")


def fct_loans(spark, sf):
    return _ntz(_facts(spark, sf), "ingest_ts")


def mart_loan_risk(spark, sf):
    return _cents(_mart(spark, sf), "total_loan_volume")


# --- reports -----------------------------------------------------------------------


def default_rate_by_grade(spark, sf):
    return reports.default_rate_by_grade(fixtures.loans(spark, sf))


def monthly_volume(spark, sf):
    return _ntz(reports.monthly_volume(fixtures.loans(spark, sf)), "issue_month")


def dpd_distribution(spark, sf):
    return reports.dpd_distribution(fixtures.loans(spark, sf))


def risk_tier_summary(spark, sf):
    return reports.risk_tier_summary(fixtures.loans(spark, sf))


def portfolio_cube(spark, sf):
    cube = reports.portfolio_cube(fixtures.loans(spark, sf))
    return _ntz(_cents(_cents(cube, "volume"), "rate_sum"), "issue_month")


def portfolio_kpis(spark, sf):
    return reports.portfolio_kpis(_mart(spark, sf))


def tier_share(spark, sf):
    return reports.tier_share(_mart(spark, sf))


def rates_by_grade(spark, sf):
    return dashboard.tiles(_mart(spark, sf))["rates_by_grade"]


def batch_report(spark, sf):
    """The whole report job, its saved result sets stacked with all their columns."""
    loans_path = scratch_path(spark, "loans")
    files.write_parquet(fixtures.loans(spark, sf), loans_path)
    saved = run_report(spark, loans_path, scratch_path(spark, "report"))
    stacked = None
    for name, frame in saved.items():
        part = frame.withColumn("report", F.lit(name))
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked.withColumn("issue_month", F.date_format("issue_month", "yyyy-MM"))


# --- ingestion and merge -----------------------------------------------------------


def _loaded_before(df: DataFrame) -> DataFrame:
    return df.where(F.col("ingest_ts") < F.lit(LOADED_BEFORE))


def merge_new_rows(spark, sf):
    batch = fixtures.raw_loans(spark, sf)
    return _ntz(merge.new_rows(batch, _loaded_before(batch)), "ingest_ts")


def merge_new_rows_shuffled(spark, sf):
    """The same merge with the new keys stored first."""
    batch = fixtures.raw_loans(spark, sf)
    return _ntz(merge.new_rows(batch, _loaded_before(batch), keys_path=scratch_path(spark, "keys")), "ingest_ts")


def merge_existing_rows(spark, sf):
    """Merging twice: what the first and the second run insert."""
    batch = fixtures.raw_loans(spark, sf)
    target = _loaded_before(batch)
    first = merge.new_rows(batch, target)
    second = merge.new_rows(batch, target.unionByName(first))
    steps = {"before": target, "first_run": first, "second_run": second}
    tagged = None
    for step, rows in steps.items():
        part = rows.select(F.lit(step).alias("step"))
        tagged = part if tagged is None else tagged.union(part)
    return tagged.agg(*[F.count_if(F.col("step") == step).alias(f"rows_{step}") for step in steps])


def merge_deduped_into_target(spark, sf):
    """A batch with copies of keys and rows without one, reduced to one row per key, into a target with some of the keys."""
    shared = row_hash(F.concat_ws("/", "purpose", "addr_state", "annual_inc"))
    batch = fixtures.loans(spark, sf).where(F.col("id").isNotNull()).select(
        F.when(F.col("grade").isNotNull(), shared).alias("row_hash"), "k", "loan_amnt"
    )
    return merge.new_rows(batch, batch.where("k % 5 = 0"), dedupe_batch=True)


def merge_deduped_batch(spark, sf):
    """One loan per customer: copies of a key inside a batch, reduced to one."""
    batch = fixtures.loans(spark, sf).where(F.col("id").isNotNull()).select(
        row_hash(F.concat_ws("/", "purpose", "addr_state", "annual_inc")).alias("row_hash"), "k", "loan_amnt"
    )
    return merge.one_row_per_key(batch)


def ingest_normalize(spark, sf):
    """CSV files into the raw table in two runs, the second overlapping the first."""
    first, everything = scratch_path(spark, "csv"), scratch_path(spark, "csv")
    raw = scratch_path(spark, "raw")
    rows = fixtures.loans(spark, sf)
    columns = fixtures.csv_loans(spark, sf).columns
    _loaded_before(rows).select(*columns).write.option("header", True).csv(first)
    rows.select(*columns).write.option("header", True).csv(everything)
    ingest(spark, first, raw, ingest_ts=F.lit(LOADS[0]))
    return _ntz(ingest(spark, everything, raw, ingest_ts=F.lit(LOADS[1])), "ingest_ts")


def merge_side_table(spark, sf):
    """Three loads into a stored raw table, whose keys lie in a bucketed side table: some loans, all of them, all again."""
    raw = scratch_path(spark, "raw")
    batch = fixtures.raw_loans(spark, sf)
    for rows in (_loaded_before(batch), batch, batch):
        merge_into_raw(spark, rows, raw)
    return _ntz(files.read_raw(spark, raw), "ingest_ts")


def ingest_new_files_once(spark, sf):
    """A folder of CSV files loaded twice as it fills up: the second run opens the new files only."""
    folder, raw, ledger = (scratch_path(spark, label) for label in ("csv", "raw", "ledger"))
    rows = fixtures.loans(spark, sf)
    columns = fixtures.csv_loans(spark, sf).columns
    loaded = F.col("ingest_ts") < F.lit(LOADED_BEFORE)
    read = []
    for stamp, part in zip(LOADS, (loaded, ~loaded)):
        rows.where(part).select(*columns).write.mode("append").option("header", True).csv(folder)
        read += ingest_new_files(spark, folder, raw, ledger, ingest_ts=F.lit(stamp))
    # Each line is taken up once.
    return _ntz(files.read_raw(spark, raw), "ingest_ts").withColumn("lines_read", F.lit(sum(read)).cast("bigint"))


def declared_months(spark, sf):
    """Rows by month as the catalog's table has them, after a load whose months alone were made known to it."""
    path = scratch_path(spark, "raw")
    batch = fixtures.raw_loans(spark, sf)
    merge_into_raw(spark, _loaded_before(batch), path)
    tables.create_layers(spark, scratch_path(spark, "layers"))
    tables.register_raw(spark, path)
    merge_into_raw(spark, batch, path, table="raw.loans_raw")
    return spark.table("raw.loans_raw").groupBy("issue_month").agg(F.count("*").alias("n_loans"))


def refresh_models(spark, sf):
    """The mart after two loads, of which the second rebuilt the changed months' facts only; with the number of months rebuilt."""
    path = scratch_path(spark, "raw")
    batch = fixtures.raw_loans(spark, sf)
    layers = scratch_path(spark, "layers")
    for layer in ("raw", "core", "mart"):
        # Databases keep the folder that they were made in.
        spark.sql(f"DROP DATABASE IF EXISTS `{layer}` CASCADE")
    tables.create_layers(spark, layers)
    later = F.col("issue_date") >= F.lit(ISSUED[0])
    merge_into_raw(spark, batch.where(~later | later.isNull()), path)
    tables.register_raw(spark, path)
    refresh.refresh_models(spark, check="report")
    merge_into_raw(spark, batch, path, table="raw.loans_raw")
    built = refresh.refresh_models(spark, check="report")
    return _cents(built["mart_loan_risk"], "total_loan_volume").withColumn("months_rebuilt", F.lit(len(built["months"])).cast("bigint"))


def model_checks(spark, sf):
    """The check report of a model build, counted while its facts are written."""
    path = scratch_path(spark, "raw")
    files.write_raw(fixtures.raw_loans(spark, sf), path)
    tables.create_layers(spark, scratch_path(spark, "layers"))
    tables.register_raw(spark, path)
    return models.build_models(spark, check="report")["report"]


def cube_of_loads(spark, sf):
    """The portfolio cube added up from the cubes of three loads."""
    cubes = scratch_path(spark, "cubes")
    loans = fixtures.loans(spark, sf)
    for load in range(3):
        add_load(loans.where(F.col("k") % 3 == load), cubes, f"part-{load}")
    cube = reports.merged_cube(files.read_parquet(spark, cubes))
    return _ntz(_cents(_cents(cube, "volume"), "rate_sum"), "issue_month")


def reject_csv(spark, sf):
    """Lines with a field too many: put aside as they are, and the others loaded."""
    csv, rejects, raw = (scratch_path(spark, label) for label in ("csv", "rejects", "raw"))
    header = F.lit(",".join(SOURCE_COLUMNS))
    # A header in front of each line that opens one of many small files.
    lines = fixtures.csv_lines(spark, sf).withColumn("file", F.spark_partition_id())
    first = F.col("k") == F.min("k").over(Window.partitionBy("file"))
    text = lines.select(F.when(first, F.concat(header, F.lit("\n"), "value")).otherwise(F.col("value")).alias("value"), "file", "k")
    text.sortWithinPartitions("file", "k").select("value").write.text(csv)
    loaded = _ntz(ingest(spark, csv, raw, ingest_ts=F.lit(LOADS[0]), rejects_path=rejects), "ingest_ts")
    kept = loaded.select(F.lit("loaded").alias("kind"), "*")
    # A rejected line's text: from the first delimiter of a number on, since the two engines print numbers in different ways, its texts.
    line = F.regexp_extract("value", r"^([^,]*),", 1).alias("id")
    fields = F.split("value", ",")
    return kept.unionByName(
        spark.read.text(rejects).select(
            F.lit("rejected").alias("kind"), line, *[F.nullif(fields[SOURCE_COLUMNS.index(c)], F.lit("")).alias(c) for c in ("grade", "sub_grade", "loan_status", "purpose", "addr_state")],
            F.concat_ws(",", fields[SOURCE_COLUMNS.index("int_rate")], fields[SOURCE_COLUMNS.index("issue_d")], fields[len(SOURCE_COLUMNS)]).alias("row_hash"),
        ),
        allowMissingColumns=True,
    )


def build_all_models(spark, sf):
    """The whole model build: a stored raw table, declared by name, to the mart, read back by its name."""
    path = scratch_path(spark, "raw")
    files.write_raw(fixtures.raw_loans(spark, sf), path)
    tables.create_layers(spark, scratch_path(spark, "layers"))
    tables.register_raw(spark, path)
    models.build_models(spark, check="report")
    return _cents(tables.source(spark.newSession(), "mart", "mart_loan_risk"), "total_loan_volume")


def raw_issue_range(spark, sf):
    """A date range of the month-partitioned raw table."""
    path = scratch_path(spark, "raw")
    files.write_raw(fixtures.raw_loans(spark, sf), path)
    return _ntz(files.read_raw(spark, path, *ISSUED), "ingest_ts")


# --- quality -----------------------------------------------------------------------


def dq_unique(spark, sf):
    return quality.check_unique(files.read_parquet(spark, f"{sf}/orders.parquet"), "o_custkey")


def dq_not_null(spark, sf):
    return quality.check_not_null(_staged(spark, sf), "grade").select("loan_id", "risk_tier")


def dq_accepted_values(spark, sf):
    return quality.check_accepted(_staged(spark, sf), "grade", list("ABCDEFG"))


def dq_report(spark, sf):
    checks = [*quality.STAGING_CHECKS, quality.Check("accepted_values", "grade", list("ABCDEFG"))]
    return quality.run_checks(_staged(spark, sf), checks)


# --- events and streams ------------------------------------------------------------


def publish_events(spark, sf):
    """Every staged loan as JSON, decoded again."""
    return event_source.parse_events(event_source.to_events(_staged(spark, sf)))


def publish_sample(spark, sf):
    """The sample that is sent to the topic: the first loans by id."""
    return event_source.parse_events(event_source.to_events(_staged(spark, sf), limit=PUBLISH_LIMIT))


def parse_events(spark, sf):
    return event_source.parse_events(fixtures.messages(spark, sf), keep=("event_id",))


def reject_events(spark, sf):
    return event_source.reject_events(fixtures.messages(spark, sf))


def delinquent_events(spark, sf):
    return _ntz(windows.delinquent_events(fixtures.loan_events(spark, sf)), "event_time")


def tumbling_window_all(spark, sf):
    result = windows.tumbling_by_grade(fixtures.loan_events(spark, sf))
    return _ntz(_cents(result, "total_volume"), "window_start", "window_end")


def session_window_all(spark, sf):
    result = windows.delinquency_sessions(fixtures.loan_events(spark, sf), gap_seconds=SESSION_GAP)
    return _ntz(_cents(result, "total_volume"), "session_start", "session_end")


def _drain(results: DataFrame, spark: SparkSession, label: str) -> DataFrame:
    """Run an append-mode stream over all there is and read what it wrote."""
    out = scratch_path(spark, label)
    start_query(results, out, scratch_path(spark, f"{label}-checkpoint"), available_now=True).awaitTermination()
    return spark.read.schema(results.schema).parquet(out)


def tumbling_window(spark, sf):
    stream = fixtures.loan_event_stream(stream_session(spark), sf)
    result = _drain(windows.tumbling_by_grade(stream, delay=DELAY), spark, "tumbling")
    return _ntz(_cents(result, "total_volume"), "window_start", "window_end")


def tumbling_window_updates(spark, sf):
    """Every window, open ones too: update mode into a versioned table, newest row per window."""
    stream = fixtures.loan_event_stream(stream_session(spark), sf)
    results = windows.tumbling_by_grade(stream, delay=DELAY)
    out = scratch_path(spark, "updates")
    checkpoint = scratch_path(spark, "updates-checkpoint")
    start_query(results, sinks.parquet_batches(out), checkpoint, "update", available_now=True).awaitTermination()
    current = sinks.latest(spark.read.parquet(out), "window_start", "window_end", "grade")
    return _ntz(_cents(current, "total_volume"), "window_start", "window_end")


def session_window(spark, sf):
    stream = fixtures.loan_event_stream(stream_session(spark), sf)
    sessions = windows.delinquency_sessions(stream, gap_seconds=SESSION_GAP, delay=DELAY)
    return _ntz(_cents(_drain(sessions, spark, "sessions"), "total_volume"), "session_start", "session_end")


def session_window_updates(spark, sf):
    """Every session, open ones too: complete mode, of which the last snapshot counts."""
    stream = fixtures.loan_event_stream(stream_session(spark), sf)
    sessions = windows.delinquency_sessions(stream, gap_seconds=SESSION_GAP, delay=DELAY)
    return _ntz(_cents(_snapshot(sessions, spark, "all-sessions"), "total_volume"), "session_start", "session_end")


def _snapshot(results: DataFrame, spark: SparkSession, label: str) -> DataFrame:
    """Run a complete-mode stream over all there is and read its last snapshot."""
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    start_query(results, sinks.snapshot_batches(out), checkpoint, "complete", available_now=True).awaitTermination()
    return sinks.newest(spark, out)


def _clocked(spark: SparkSession, sf: str) -> DataFrame:
    return windows.with_processing_time(fixtures.loan_event_stream(stream_session(spark), sf).drop("event_time"))


def _volumes(windows_: DataFrame, count: str) -> DataFrame:
    """Counts and volume per grade over all windows, whose own times depend on the clock."""
    sums = windows_.groupBy("grade").agg(F.sum(count).alias("total_loans"), F.sum("total_volume").alias("total_volume"))
    return _cents(sums, "total_volume")


def clocked_tumbling(spark, sf):
    """Windows by processing time in a run that ends: their updates hold every event."""
    out, checkpoint = scratch_path(spark, "clocked"), scratch_path(spark, "clocked-checkpoint")
    results = windows.tumbling_by_grade(_clocked(spark, sf))
    start_query(results, sinks.parquet_batches(out), checkpoint, "update", available_now=True).awaitTermination()
    return _volumes(sinks.latest(spark.read.parquet(out), "window_start", "window_end", "grade"), "total_loans")


def clocked_sessions(spark, sf):
    """Sessions by processing time in a run that ends."""
    return _volumes(_snapshot(windows.delinquency_sessions(_clocked(spark, sf)), spark, "clocked"), "events_in_session")


def _replay(spark: SparkSession, sf: str) -> DataFrame:
    """Staged loans published as JSON files and read back as a stream of events."""
    topic = scratch_path(spark, "topic")
    event_source.to_events(_staged(spark, sf)).select("value").write.text(topic)
    return event_source.parse_events(stream_session(spark).readStream.text(topic))


def stream_replay(spark, sf):
    return _drain(_replay(spark, sf), spark, "replay")


def delinquency_by_grade(spark, sf):
    """Counts per grade as the running counter last reported them."""
    counts = counter.delinquency_by_grade(_replay(spark, sf))
    return _snapshot(counts, spark, "counter").orderBy("grade")


def counter_reports(spark, sf):
    """A report whenever 500 more messages have come, over a folder of files, in the order of the loans' ids."""
    out = scratch_path(spark, "reports")
    write = counter.reports_every(out, REPORT_EVERY, order=("loan_id",))
    start_query(_replay(spark, sf), write, scratch_path(spark, "reports-checkpoint"), available_now=True).awaitTermination()
    told = counter.reports(spark, out)
    return told.withColumn("by_grade", F.array_join(F.transform(F.map_entries("by_grade"), lambda e: F.concat_ws(":", e["key"], e["value"])), ","))


def late_rows_by_batch(spark, sf):
    """What the watermark dropped (windows of a grade in a batch), as the batches' stored figures have it: three files, the last one late."""
    topic, figures = scratch_path(spark, "topic"), scratch_path(spark, "late")
    events = fixtures.loan_events(spark, sf)
    parts = [F.dayofmonth("event_time").between(*days) for days in LATE_DAYS]
    stream = stream_session(spark).readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{topic}/*")
    out = scratch_path(spark, "late-windows")
    results = windows.tumbling_by_grade(stream, delay=DELAY)
    checkpoint = scratch_path(spark, "late-checkpoint")
    for n, part in enumerate(parts):
        # One file, and one run, for each part, so that they come in this order.
        events.where(part).coalesce(1).write.parquet(f"{topic}/{n}")
        query = start_query(results, out, checkpoint, available_now=True, late_path=figures)
        query.awaitTermination()
        late_rows(query)  # waits for the last batch's figure
    return late_figures(spark, figures).agg(F.coalesce(F.sum("dropped"), F.lit(0)).alias("dropped"))


def delinquency_counter(spark, sf):
    return counter.delinquency_totals(delinquency_by_grade(spark, sf))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name."""
    return own_queries() | (llm_queries.queries() if llm_queries else {})


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of this library without its subpackage `llm`."""
    return {
        "scan_loans": scan_loans,
        "external_view": external_view,
        "row_count": row_count,
        "clean_rate": clean_rate,
        "default_flag": default_flags,
        "risk_tier": risk_tiers,
        "dpd_bucket": dpd_buckets,
        "parse_issue_date": parse_issue_date,
        "row_hash": row_hashes,
        "to_raw_schema": raw_schema,
        "stg_loans": stg_loans,
        "fct_loans": fct_loans,
        "mart_loan_risk": mart_loan_risk,
        "default_rate_by_grade": default_rate_by_grade,
        "monthly_volume": monthly_volume,
        "dpd_distribution": dpd_distribution,
        "risk_tier_summary": risk_tier_summary,
        "portfolio_cube": portfolio_cube,
        "portfolio_kpis": portfolio_kpis,
        "tier_share": tier_share,
        "rates_by_grade": rates_by_grade,
        "batch_report": batch_report,
        "merge_new_rows": merge_new_rows,
        "merge_new_rows_shuffled": merge_new_rows_shuffled,
        "merge_existing_rows": merge_existing_rows,
        "merge_deduped_batch": merge_deduped_batch,
        "merge_deduped_into_target": merge_deduped_into_target,
        "reject_csv": reject_csv,
        "merge_side_table": merge_side_table,
        "ingest_new_files": ingest_new_files_once,
        "declared_months": declared_months,
        "build_models": build_all_models,
        "model_checks": model_checks,
        "refresh_models": refresh_models,
        "cube_of_loads": cube_of_loads,
        "ingest_normalize": ingest_normalize,
        "raw_issue_range": raw_issue_range,
        "dq_unique": dq_unique,
        "dq_not_null": dq_not_null,
        "dq_accepted_values": dq_accepted_values,
        "dq_report": dq_report,
        "publish_events": publish_events,
        "publish_sample": publish_sample,
        "parse_events": parse_events,
        "reject_events": reject_events,
        "delinquent_events": delinquent_events,
        "tumbling_window": tumbling_window,
        "tumbling_window_all": tumbling_window_all,
        "tumbling_window_updates": tumbling_window_updates,
        "session_window": session_window,
        "session_window_all": session_window_all,
        "session_window_updates": session_window_updates,
        "clocked_tumbling": clocked_tumbling,
        "clocked_sessions": clocked_sessions,
        "stream_replay": stream_replay,
        "counter_reports": counter_reports,
        "late_rows_by_batch": late_rows_by_batch,
        "delinquency_counter": delinquency_counter,
        "delinquency_by_grade": delinquency_by_grade,
    }


# --- the same in SQL ---------------------------------------------------------------

_LOANS = """
loans AS (
  SELECT
    CASE WHEN k % 97 <> 96 THEN CAST(k AS VARCHAR) END AS id,
    price AS loan_amnt,
    CASE WHEN k % 101 = 100 THEN CAST(0 AS DOUBLE) ELSE price * CAST(0.75 AS DOUBLE) END AS funded_amnt,
    grade,
    grade || CAST(k % 5 + 1 AS VARCHAR) AS sub_grade,
    CASE WHEN k % 89 = 88 THEN 'n/a'
         ELSE CAST(5 + k % 20 AS VARCHAR) || '.' || lpad(CAST(k * 37 % 100 AS VARCHAR), 2, '0') || '%'
    END AS int_rate,
    CASE k % 8 WHEN 0 THEN 'Fully Paid' WHEN 1 THEN 'Charged Off' WHEN 2 THEN 'Current'
      WHEN 3 THEN 'Default' WHEN 4 THEN 'Does not meet the credit policy. Status:Charged Off'
      WHEN 5 THEN 'charged off' WHEN 6 THEN 'Fully Paid' END AS loan_status,
    CASE WHEN k % 83 = 82 THEN 'junk'
         WHEN k % 3 = 0 THEN strftime(ordered, '%b-%y')
         ELSE strftime(ordered, '%b-%Y') END AS issue_d,
    purpose, addr_state,
    CASE WHEN k % 3 <> 0 THEN k % 130 END AS mths_since_last_delinq,
    price * CAST(0.5 AS DOUBLE) AS total_pymnt,
    price - price * CAST(0.5 AS DOUBLE) AS out_prncp,
    CASE WHEN k % 4 <> 0 THEN k % 5 END AS delinq_2yrs,
    annual_inc,
    CAST(k % 4000 AS DOUBLE) / CAST(100 AS DOUBLE) AS dti,
    ordered AS ingest_ts,
    k
  FROM (
    SELECT o_orderkey AS k, o_totalprice AS price, o_orderdate AS ordered,
      CASE o_orderkey % 9 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'D'
        WHEN 4 THEN 'E' WHEN 5 THEN 'F' WHEN 6 THEN 'G' WHEN 7 THEN 'H' END AS grade,
      c_mktsegment AS purpose, CAST(c_nationkey AS VARCHAR) AS addr_state, c_acctbal AS annual_inc
    FROM orders JOIN customer ON o_custkey = c_custkey
  )
)"""

# The statuses, tiers and buckets of the data model, as in gradewise/schemas.py.
_RATE = "TRY_CAST(replace(int_rate, '%', '') AS DOUBLE)"
_BAD = "('charged off', 'default', 'does not meet the credit policy. status:charged off')"
_BAD_EXACT = "('Charged Off', 'Default', 'Does not meet the credit policy. Status:Charged Off')"
_TIER = """CASE WHEN grade IN ('A', 'B') THEN 'Low Risk' WHEN grade IN ('C', 'D') THEN 'Medium Risk'
      WHEN grade IN ('E', 'F', 'G') THEN 'High Risk' ELSE 'Unknown' END"""
_BUCKET = """CASE WHEN coalesce(mths_since_last_delinq, 0) = 0 THEN '1_Current'
      WHEN mths_since_last_delinq <= 30 THEN '2_DPD 1-30' WHEN mths_since_last_delinq <= 60 THEN '3_DPD 31-60'
      WHEN mths_since_last_delinq <= 90 THEN '4_DPD 61-90' ELSE '5_DPD 90+' END"""
_ISSUED = """CAST(CASE WHEN length(issue_d) = 6 THEN try_strptime(issue_d, '%b-%y')
      ELSE try_strptime(issue_d, '%b-%Y') END AS DATE)"""


def _round(expression: str, digits: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(28,9)), {digits}) AS DOUBLE)"


_RICH = f"""{_LOANS},
rich AS (
  SELECT * EXCLUDE (int_rate), {_RATE} AS int_rate,
    CASE WHEN lower(loan_status) IN {_BAD} THEN 1 ELSE 0 END AS is_defaulted,
    {_TIER} AS risk_tier, date_trunc('month', ingest_ts) AS issue_month, {_BUCKET} AS bucket
  FROM loans
)"""

_RAW = f"""{_LOANS},
raw AS (
  SELECT id, loan_amnt, funded_amnt, grade, sub_grade, {_RATE} AS int_rate, loan_status,
    {_ISSUED} AS issue_date, purpose, addr_state,
    CAST(mths_since_last_delinq AS BIGINT) AS mths_since_last_delinq, total_pymnt, out_prncp,
    CAST(delinq_2yrs AS BIGINT) AS delinq_2yrs, annual_inc, dti,
    CAST(ingest_ts AS TIMESTAMP) AS ingest_ts, md5(id) AS row_hash
  FROM loans WHERE id IS NOT NULL
)"""

_STG = f"""{_RAW},
stg AS (
  SELECT id AS loan_id, loan_amnt AS loan_amount, funded_amnt AS funded_amount, grade, sub_grade,
    int_rate AS interest_rate, loan_status, issue_date, purpose, addr_state AS state,
    coalesce(mths_since_last_delinq, 0) AS mths_since_last_delinq, total_pymnt AS total_payment,
    out_prncp AS outstanding_principal, coalesce(delinq_2yrs, 0) AS delinq_2yrs,
    annual_inc AS annual_income, dti, ingest_ts, row_hash, {_TIER} AS risk_tier
  FROM raw
)"""

_FCT = f"""{_STG},
fct AS (
  SELECT *, CASE WHEN funded_amount <> 0 THEN {_round("total_payment / funded_amount * 100", 2)} END
      AS repayment_rate_pct,
    coalesce(lower(loan_status) IN {_BAD}, false) AS is_defaulted
  FROM stg
)"""

_MART = f"""{_FCT},
mart AS (
  SELECT grade, risk_tier, count(*) AS total_loans,
    {_round("avg(interest_rate)", 2)} AS avg_interest_rate, {_round("avg(dti)", 2)} AS avg_dti,
    {_round("avg(annual_income)", 2)} AS avg_annual_income,
    {_round("avg(loan_amount)", 2)} AS avg_loan_amount,
    {_round("sum(loan_amount)", 2)} AS total_loan_volume,
    {_round("avg(repayment_rate_pct)", 2)} AS avg_repayment_rate_pct,
    count(*) FILTER (is_defaulted) AS total_defaults,
    {_round("count(*) FILTER (is_defaulted) * CAST(100 AS DOUBLE) / count(*)", 2)} AS default_rate_pct
  FROM fct GROUP BY grade, risk_tier
)"""

_EVENTS = """
loan_events AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS loan_id, event_type AS grade, value AS loan_amount,
    value AS interest_rate, CASE WHEN event_type = 'error' THEN 'Default' ELSE 'Current' END AS loan_status,
    CASE WHEN value > 50 THEN CAST(floor(value) AS INTEGER) END AS mths_since_last_delinq,
    CAST(ts AS TIMESTAMP) AS event_time
  FROM events
)"""

_TUMBLING = f"""{_EVENTS},
windows AS (
  SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
    time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end, grade,
    count(*) AS total_loans, {_round("sum(loan_amount)", 2)} AS total_volume,
    {_round("avg(interest_rate)", 2)} AS avg_interest
  FROM loan_events GROUP BY ALL
)"""

_SESSIONS = f"""{_EVENTS},
wanted AS (
  SELECT * FROM loan_events WHERE loan_status IN {_BAD_EXACT} OR mths_since_last_delinq > 0
),
marked AS (
  SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY grade ORDER BY event_time)
      <= INTERVAL '{SESSION_GAP} seconds' THEN 0 ELSE 1 END AS starts
  FROM wanted
),
numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY grade ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS n FROM marked
),
sessions AS (
  SELECT min(event_time) AS session_start, max(event_time) + INTERVAL '{SESSION_GAP} seconds' AS session_end,
    grade, count(*) AS events_in_session, {_round("sum(loan_amount)", 2)} AS total_volume
  FROM numbered GROUP BY grade, n
)"""

# A stream closes what its watermark, of millisecond precision, has passed.
_CLOSED = "(SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL '1 minute' FROM {events})"

_BY_GRADE = f"""{_STG},
by_grade AS (
  SELECT coalesce(grade, 'Unknown') AS grade, count(*) AS total_loans,
    count(*) FILTER (mths_since_last_delinq > 0) AS delinquent_loans
  FROM stg GROUP BY 1
)"""

_EVENT_COLUMNS = """loan_id, grade, loan_amount, interest_rate, loan_status,
  strftime(issue_date, '%Y-%m-%d') AS issue_date,
  CAST(mths_since_last_delinq AS INTEGER) AS mths_since_last_delinq, total_payment,
  outstanding_principal, risk_tier"""

_RATES = f"""{_round("avg(is_defaulted) * 100", 2)} AS default_rate_pct"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query, over the same tables."""
    return own_sql() | (llm_queries.oracle_sql() if llm_queries else {})


def own_sql() -> dict[str, str]:
    """The SQL of `own_queries`."""
    loaded = f"ingest_ts < TIMESTAMP '{LOADED_BEFORE:%Y-%m-%d %H:%M:%S}'"
    raw_columns = ", ".join(RAW_SCHEMA.fieldNames())
    merged = f"""WITH {_RAW}
      SELECT {raw_columns} FROM raw b
      WHERE NOT EXISTS (SELECT 1 FROM raw t WHERE t.{loaded} AND t.row_hash = b.row_hash)"""
    cube = f"""WITH {_RICH} SELECT grade, risk_tier, CAST(issue_month AS TIMESTAMP) AS issue_month,
        bucket AS dpd_bucket, count(*) AS n_loans, CAST(sum(is_defaulted) AS BIGINT) AS n_defaults,
        {_round("sum(loan_amnt)", 2)} AS volume, {_round("sum(int_rate)", 2)} AS rate_sum,
        count(int_rate) AS rate_n
        FROM rich GROUP BY grade, risk_tier, rich.issue_month, bucket"""
    staged_checks = f"""WITH {_STG}
        SELECT 'unique_loan_id' AS check_name, 'loan_id' AS column_name, count(*) AS failures FROM
          (SELECT loan_id FROM stg WHERE loan_id IS NOT NULL GROUP BY loan_id HAVING count(*) > 1)
        UNION ALL SELECT 'not_null_loan_id', 'loan_id', count(*) FROM stg WHERE loan_id IS NULL
        UNION ALL SELECT 'not_null_grade', 'grade', count(*) FROM stg WHERE grade IS NULL
        UNION ALL SELECT 'not_null_loan_status', 'loan_status', count(*) FROM stg WHERE loan_status IS NULL
        UNION ALL SELECT 'accepted_values_risk_tier', 'risk_tier', count(DISTINCT risk_tier) FROM stg
          WHERE risk_tier NOT IN ('Low Risk', 'Medium Risk', 'High Risk', 'Unknown')"""
    publish = f"WITH {_STG} SELECT {_EVENT_COLUMNS} FROM stg"
    return {
        "scan_loans": f"WITH {_LOANS} SELECT * EXCLUDE (k) FROM loans",
        "external_view": "SELECT * FROM customer",
        "row_count": f"WITH {_LOANS} SELECT count(*) AS total_rows FROM loans",
        "clean_rate": f"WITH {_LOANS} SELECT k, {_RATE} AS int_rate FROM loans",
        "default_flag": f"""WITH {_LOANS} SELECT k, loan_status,
            CASE WHEN lower(loan_status) IN {_BAD} THEN 1 ELSE 0 END AS is_defaulted,
            coalesce(loan_status IN {_BAD_EXACT}, false) AS is_defaulted_exact FROM loans""",
        "risk_tier": f"WITH {_LOANS} SELECT k, grade, {_TIER} AS risk_tier FROM loans",
        "dpd_bucket": f"WITH {_LOANS} SELECT k, mths_since_last_delinq, {_BUCKET} AS dpd_bucket FROM loans",
        "parse_issue_date": f"WITH {_LOANS} SELECT k, issue_d, {_ISSUED} AS issue_date FROM loans",
        "row_hash": f"WITH {_LOANS} SELECT k, md5(id) AS row_hash FROM loans",
        "to_raw_schema": f"WITH {_RAW} SELECT * FROM raw",
        "stg_loans": f"WITH {_STG} SELECT * FROM stg",
        "fct_loans": f"WITH {_FCT} SELECT * FROM fct",
        "mart_loan_risk": f"WITH {_MART} SELECT * FROM mart",
        "default_rate_by_grade": f"""WITH {_RICH} SELECT grade, count(*) AS total_loans,
            CAST(sum(is_defaulted) AS BIGINT) AS total_defaults, {_RATES},
            {_round("avg(int_rate)", 2)} AS avg_interest_rate FROM rich GROUP BY grade""",
        "monthly_volume": f"""WITH {_RICH} SELECT CAST(issue_month AS TIMESTAMP) AS issue_month,
            count(*) AS total_loans, {_round("sum(loan_amnt)", 2)} AS total_volume_usd,
            {_round("avg(int_rate)", 2)} AS avg_interest_rate FROM rich GROUP BY issue_month""",
        "dpd_distribution": f"""WITH {_RICH} SELECT substr(bucket, 3) AS dpd_bucket, count(*) AS total_loans,
            {_round("count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM rich)", 1)} AS pct
            FROM rich GROUP BY bucket""",
        "risk_tier_summary": f"""WITH {_RICH} SELECT risk_tier, count(*) AS total_loans, {_RATES},
            {_round("sum(loan_amnt)", 2)} AS total_volume_usd FROM rich GROUP BY risk_tier""",
        "portfolio_cube": cube,
        "cube_of_loads": cube,
        "portfolio_kpis": f"""WITH {_MART} SELECT CAST(sum(total_loans) AS BIGINT) AS total_loans,
            {_round("sum(total_loan_volume)", 2)} AS total_volume_usd,
            {_round("sum(total_defaults) * CAST(100 AS DOUBLE) / sum(total_loans)", 2)} AS default_rate_pct,
            {_round("avg(default_rate_pct)", 2)} AS mean_grade_default_rate_pct,
            {_round("sum(total_loans) FILTER (risk_tier = 'Low Risk') * CAST(100 AS DOUBLE) / sum(total_loans)", 1)}
              AS low_risk_share_pct FROM mart""",
        "tier_share": f"""WITH {_MART} SELECT risk_tier, CAST(sum(total_loans) AS BIGINT) AS total_loans,
            {_round("sum(total_loans) * CAST(100 AS DOUBLE) / (SELECT sum(total_loans) FROM mart)", 1)} AS share_pct
            FROM mart GROUP BY risk_tier""",
        "rates_by_grade": f"""WITH {_MART}
            SELECT grade, default_rate_pct, avg_interest_rate, total_loans FROM mart""",
        "batch_report": f"""WITH {_RICH}
            SELECT 'default_by_grade' AS report, grade, count(*) AS total_loans, CAST(sum(is_defaulted) AS BIGINT) AS total_defaults,
              {_RATES}, {_round("avg(int_rate)", 2)} AS avg_interest_rate, CAST(NULL AS VARCHAR) AS issue_month,
              CAST(NULL AS DOUBLE) AS total_volume_usd, CAST(NULL AS VARCHAR) AS dpd_bucket, CAST(NULL AS DOUBLE) AS pct,
              CAST(NULL AS VARCHAR) AS risk_tier FROM rich GROUP BY grade
            UNION ALL BY NAME SELECT 'monthly_volume' AS report, strftime(issue_month, '%Y-%m') AS issue_month, count(*) AS total_loans,
              {_round("sum(loan_amnt)", 2)} AS total_volume_usd, {_round("avg(int_rate)", 2)} AS avg_interest_rate FROM rich GROUP BY rich.issue_month
            UNION ALL BY NAME SELECT 'dpd_distribution' AS report, substr(bucket, 3) AS dpd_bucket, count(*) AS total_loans,
              {_round("count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM rich)", 1)} AS pct FROM rich GROUP BY bucket
            UNION ALL BY NAME SELECT 'risk_tier_summary' AS report, risk_tier, count(*) AS total_loans, {_RATES},
              {_round("sum(loan_amnt)", 2)} AS total_volume_usd FROM rich GROUP BY risk_tier""",
        "merge_new_rows": merged,
        "merge_new_rows_shuffled": merged,
        "merge_existing_rows": f"""WITH {_RAW} SELECT count(*) FILTER ({loaded}) AS rows_before,
            count(*) FILTER (NOT {loaded}) AS rows_first_run, CAST(0 AS BIGINT) AS rows_second_run FROM raw""",
        "merge_deduped_batch": f"""WITH {_LOANS}, batch AS (
              SELECT md5(concat_ws('/', purpose, addr_state, CAST(annual_inc AS VARCHAR))) AS row_hash, k, loan_amnt
              FROM loans WHERE id IS NOT NULL)
            SELECT row_hash, min(k) AS k, arg_min(loan_amnt, k) AS loan_amnt FROM batch GROUP BY row_hash""",
        "merge_deduped_into_target": f"""WITH {_LOANS}, batch AS (
              SELECT CASE WHEN grade IS NOT NULL THEN
                md5(concat_ws('/', purpose, addr_state, CAST(annual_inc AS VARCHAR))) END AS row_hash, k, loan_amnt
              FROM loans WHERE id IS NOT NULL)
            SELECT row_hash, min(k) AS k, arg_min(loan_amnt, k) AS loan_amnt FROM batch WHERE row_hash IS NOT NULL
              AND row_hash NOT IN (SELECT row_hash FROM batch WHERE k % 5 = 0 AND row_hash IS NOT NULL) GROUP BY row_hash
            UNION ALL SELECT * FROM batch WHERE row_hash IS NULL""",
        "reject_csv": f"""WITH {_RAW}
            SELECT 'loaded' AS kind, raw.* REPLACE (TIMESTAMP '{LOADS[0]}' AS ingest_ts) FROM raw WHERE CAST(id AS BIGINT) % 7 <> 0
            UNION ALL BY NAME SELECT 'rejected' AS kind, coalesce(id, '') AS id, grade, sub_grade, loan_status, purpose, addr_state,
              int_rate || ',' || issue_d || ',EXTRA' AS row_hash FROM loans WHERE k % 7 = 0""",
        "merge_side_table": f"WITH {_RAW} SELECT {raw_columns} FROM raw",
        "ingest_new_files": f"""WITH {_RAW} SELECT * REPLACE (CASE WHEN {loaded} THEN TIMESTAMP '{LOADS[0]}'
            ELSE TIMESTAMP '{LOADS[1]}' END AS ingest_ts), (SELECT count(*) FROM loans) AS lines_read FROM raw""",
        "declared_months": f"WITH {_RAW} SELECT strftime(issue_date, '%Y-%m') AS issue_month, count(*) AS n_loans FROM raw GROUP BY 1",
        "model_checks": staged_checks,
        "refresh_models": f"""WITH {_MART} SELECT *, (SELECT count(DISTINCT strftime(issue_date, '%Y-%m')) FROM raw
            WHERE issue_date >= DATE '{ISSUED[0]}') AS months_rebuilt FROM mart""",
        "build_models": f"WITH {_MART} SELECT * FROM mart",
        "ingest_normalize": f"""WITH {_RAW} SELECT * REPLACE (CASE WHEN {loaded} THEN TIMESTAMP '{LOADS[0]}'
            ELSE TIMESTAMP '{LOADS[1]}' END AS ingest_ts) FROM raw""",
        "raw_issue_range": f"""WITH {_RAW} SELECT * FROM raw
            WHERE issue_date BETWEEN DATE '{ISSUED[0]}' AND DATE '{ISSUED[1]}'""",
        "dq_unique": """SELECT o_custkey, count(*) AS n_records FROM orders
            WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1""",
        "dq_not_null": f"WITH {_STG} SELECT loan_id, risk_tier FROM stg WHERE grade IS NULL",
        "dq_accepted_values": f"""WITH {_STG} SELECT grade, count(*) AS n_records FROM stg
            WHERE grade NOT IN ('A', 'B', 'C', 'D', 'E', 'F', 'G') GROUP BY grade""",
        "dq_report": f"""{staged_checks}
            UNION ALL SELECT 'accepted_values_grade', 'grade', count(DISTINCT grade) FROM stg
              WHERE grade NOT IN ('A', 'B', 'C', 'D', 'E', 'F', 'G')""",
        "publish_events": publish,
        "publish_sample": f"{publish} ORDER BY loan_id LIMIT {PUBLISH_LIMIT}",
        "parse_events": f"""WITH {_EVENTS}, fields AS (SELECT event_id, loan_id, grade,
              CASE WHEN event_id % 8 <> 2 THEN loan_amount END AS loan_amount, interest_rate, loan_status,
              strftime(event_time, '%Y-%m-%d') AS issue_date, mths_since_last_delinq, loan_amount * 0.5 AS total_payment,
              loan_amount * 0.25 AS outstanding_principal, {_TIER} AS risk_tier FROM loan_events)
            SELECT * FROM fields WHERE event_id % 8 NOT IN (3, 4, 5, 6)
            UNION ALL BY NAME SELECT event_id FROM fields WHERE event_id % 8 = 4""",
        "reject_events": """SELECT event_id,
            CASE event_id % 8 WHEN 3 THEN 'not json' WHEN 6 THEN '[1]' END AS value
            FROM events WHERE event_id % 8 IN (3, 5, 6)""",
        "delinquent_events": f"""WITH {_EVENTS} SELECT * FROM loan_events
            WHERE loan_status IN {_BAD_EXACT} OR mths_since_last_delinq > 0""",
        "tumbling_window": f"""WITH {_TUMBLING} SELECT * FROM windows
            WHERE window_end <= {_CLOSED.format(events="loan_events")}""",
        "tumbling_window_all": f"WITH {_TUMBLING} SELECT * FROM windows",
        "tumbling_window_updates": f"WITH {_TUMBLING} SELECT * FROM windows",
        "session_window": f"""WITH {_SESSIONS} SELECT * FROM sessions
            WHERE session_end <= {_CLOSED.format(events="wanted")}""",
        "session_window_all": f"WITH {_SESSIONS} SELECT * FROM sessions",
        "session_window_updates": f"WITH {_SESSIONS} SELECT * FROM sessions",
        "clocked_tumbling": f"""WITH {_EVENTS} SELECT grade, count(*) AS total_loans,
            {_round("sum(loan_amount)", 2)} AS total_volume FROM loan_events GROUP BY grade""",
        "clocked_sessions": f"""WITH {_EVENTS} SELECT grade, count(*) AS total_loans,
            {_round("sum(loan_amount)", 2)} AS total_volume FROM loan_events
            WHERE loan_status IN {_BAD_EXACT} OR mths_since_last_delinq > 0 GROUP BY grade""",
        "stream_replay": publish,
        "counter_reports": f"""WITH {_STG}, placed AS (
              SELECT coalesce(grade, 'Unknown') AS grade, coalesce(mths_since_last_delinq > 0, false) AS delinquent,
                row_number() OVER (ORDER BY loan_id) AS place FROM stg),
            due AS (SELECT unnest(range({REPORT_EVERY}, (SELECT count(*) FROM stg) + 1, {REPORT_EVERY})) AS total_loans),
            counted AS (SELECT total_loans, grade, count(*) AS n, count(*) FILTER (delinquent) AS d
              FROM due JOIN placed ON place <= total_loans GROUP BY ALL)
            SELECT total_loans, CAST(sum(d) AS BIGINT) AS delinquent_loans,
              {_round("sum(d) / CAST(total_loans AS DOUBLE) * 100", 1)} AS delinquency_rate_pct,
              string_agg(grade || ':' || n, ',' ORDER BY grade) AS by_grade FROM counted GROUP BY total_loans""",
        "late_rows_by_batch": f"""WITH {_EVENTS}, parts AS (
              SELECT event_time, grade, CASE {" ".join(f"WHEN day(event_time) BETWEEN {a} AND {b} THEN {n}" for n, (a, b) in enumerate(LATE_DAYS))} END AS part
              FROM loan_events),
            marks AS (SELECT part, date_trunc('milliseconds', max(event_time)) - INTERVAL '1 minute' AS mark FROM parts GROUP BY part)
            SELECT count(DISTINCT (p.part, time_bucket(INTERVAL '5 minutes', event_time), grade)) AS dropped FROM parts p
            WHERE time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' <= (SELECT max(mark) FROM marks m WHERE m.part < p.part)""",
        "delinquency_counter": f"""WITH {_BY_GRADE} SELECT CAST(sum(total_loans) AS BIGINT) AS total_loans,
            CAST(sum(delinquent_loans) AS BIGINT) AS delinquent_loans,
            {_round("sum(delinquent_loans) / CAST(sum(total_loans) AS DOUBLE) * 100", 1)} AS delinquency_rate_pct
            FROM by_grade""",
        "delinquency_by_grade": f"WITH {_BY_GRADE} SELECT * FROM by_grade",
    }

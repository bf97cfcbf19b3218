"""Ingestion: CSV files to the raw table by an insert-only merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradewise.functions import parse_issue_month, percent_to_double, row_hash
from gradewise.operators.merge import new_rows
from gradewise.schemas import RAW_SCHEMA, SOURCE_COLUMNS
from gradewise.session import list_folder, path_exists, scratch
from gradewise.sources import keys
from gradewise.sources.files import RECORD, csv_rejects, csv_stream, loan_text, read_loans_csv, read_raw, surplus_lines, write_raw
from gradewise.sources.tables import add_months
from gradewise.streaming.runner import start_query


def pick_columns(df: DataFrame, columns: Sequence[str] = SOURCE_COLUMNS, required: Sequence[str] = ("id",)) -> DataFrame:
    """Only the given columns; one that the input lacks becomes NULL text, but a required one must be there."""
    present = set(df.columns)
    if missing := [c for c in required if c not in present]:
        raise ValueError(f"the input lacks the columns {missing}; it has {df.columns}")
    return df.select(*[
        F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in columns
    ])


def _as(field: T.StructField, have: T.DataType) -> Column:
    """A column in the raw table's type; what does not fit is NULL."""
    value = F.col(field.name)
    want = field.dataType
    if have == want:
        return value
    if isinstance(want, T.DoubleType) and isinstance(have, T.StringType):
        return percent_to_double(value) if field.name == "int_rate" else value.try_cast("double")
    if isinstance(want, T.LongType) and not isinstance(have, T.IntegralType):
        # A counter with gaps arrives as `12.0`.
        return F.round(value.try_cast("double"), 0).try_cast("bigint")
    return value.try_cast(want)


def to_raw_schema(df: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Rows with an id, cast to the raw schema, with a load timestamp and the row hash.

    Takes a column `issue_d` (month text) or `issue_date`. `ingest_ts` defaults to now;
    one given fixes it, and a load timestamp or hash in the input is not trusted.
    """
    if "issue_d" in df.columns:
        df = df.withColumn("issue_date", parse_issue_month(F.col("issue_d"))).drop("issue_d")
    have = {f.name: f.dataType for f in df.schema}
    loaded_at = F.current_timestamp() if ingest_ts is None else ingest_ts.cast("timestamp")
    columns = []
    for field in RAW_SCHEMA:
        if field.name == "ingest_ts":
            columns.append(loaded_at.alias("ingest_ts"))
        elif field.name == "row_hash":
            columns.append(row_hash(F.col("id")).alias("row_hash"))
        else:
            columns.append(_as(field, have[field.name]).alias(field.name))
    return df.where(F.col("id").isNotNull()).select(*columns)


def merge_into_raw(
    spark: SparkSession, staged: DataFrame, raw_path: str, dedupe_batch: bool = False, table: str | None = None,
) -> list[str | None]:
    """Append the staged rows that the raw table lacks; returns the issue months that got rows.

    The table's keys come from its side table (`sources.keys`). One writer at a time. A run that dies half-way is repaired
    by running it again, as rows already written are then found and skipped. Only copies of one id inside a batch, kept
    when `dedupe_batch` is off, can come out fewer after such a repair. The months are made known to the catalog's `table`, if one is named.
    """
    target = read_raw(spark, raw_path) if path_exists(spark, raw_path) else None
    held = None if target is None else keys.held_keys(spark, target, raw_path)
    with scratch(spark, "new-keys") as fresh:
        rows = new_rows(staged, held, dedupe_batch=dedupe_batch, keys_path=fresh)
        with keys.loading(spark, raw_path):
            months = write_raw(rows, raw_path)
            added = spark.read.schema(staged.select(keys.KEY).schema).parquet(fresh)
            if held is None:
                keys.build_keys(spark, added, raw_path)
            else:
                keys.add_keys(spark, added, raw_path)
    if table is not None:
        add_months(spark, table, months)
    return months


def ingest(
    spark: SparkSession,
    csv_path: str | list[str],
    raw_path: str,
    ingest_ts: Column | None = None,
    dedupe_batch: bool = False,
    one_line_per_record: bool = False,
    rejects_path: str | None = None,
    table: str | None = None,
) -> DataFrame:
    """Load CSV files into the raw table; returns the raw table after the merge.

    A line with more fields than its header stops the load, or is put aside as text in `rejects_path`
    if that is given. The typed batch is written to the shared scratch folder first, so that the text is parsed
    once and a lost executor re-reads Parquet instead of CSV; it is deleted once the rows are in the table, and
    also if the load fails.
    """
    if rejects_path is None:
        text = read_loans_csv(spark, csv_path, one_line_per_record)
    else:
        csv_rejects(spark, csv_path, one_line_per_record).write.mode("append").text(rejects_path)
        text = read_loans_csv(spark, csv_path, one_line_per_record, surplus="drop")
    _load(spark, to_raw_schema(pick_columns(text), ingest_ts), raw_path, dedupe_batch, table)
    return read_raw(spark, raw_path)


def _load(spark: SparkSession, batch: DataFrame, raw_path: str, dedupe_batch: bool, table: str | None) -> None:
    with scratch(spark, "staged-loans") as staged:
        batch.write.parquet(staged)
        merge_into_raw(spark, spark.read.schema(RAW_SCHEMA).parquet(staged), raw_path, dedupe_batch, table)


def ingest_new_files(
    spark: SparkSession,
    folder: str,
    raw_path: str,
    checkpoint: str,
    ingest_ts: Column | None = None,
    dedupe_batch: bool = False,
    one_line_per_record: bool = False,
    rejects_path: str | None = None,
    table: str | None = None,
    files_per_batch: int | None = None,
) -> list[int]:
    """Load the CSV files of a folder that no run with this checkpoint has loaded; returns the input rows of each batch.

    The stream's checkpoint is the ledger: it names the files taken up, whatever their number, so a run opens new files only. A run that
    dies loads its batch again; the merge skips the rows that are in. A file counts by its name: one that is changed in place isn't
    read again. All files must have one header. With `files_per_batch` a large backlog comes in several batches. The other
    parameters are `ingest`'s.
    """
    if not [n for n in list_folder(spark, folder) if not n.startswith(("_", "."))]:
        return []
    lines, surplus = csv_stream(spark, folder, one_line_per_record, files_per_batch)

    def typed(text: DataFrame) -> DataFrame:
        return to_raw_schema(pick_columns(text), ingest_ts)

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if rejects_path is None:
            _load(session, typed(loan_text(batch, surplus)), raw_path, dedupe_batch, table)
            return
        with scratch(session, "csv-lines") as parsed:
            # The files are parsed once, though the lines part here.
            marked = batch.withColumn("_surplus", surplus.cast("string"))
            pick_columns(marked, (*SOURCE_COLUMNS, RECORD, "_surplus"), ("id", RECORD)).write.parquet(parsed)
            found = session.read.parquet(parsed)
            too_many = F.col("_surplus") == "true"
            # A batch's rejects replace those of its first try.
            surplus_lines(found, too_many).write.mode("overwrite").text(f"{rejects_path.rstrip('/')}/batch_id={batch_id}")
            _load(session, typed(loan_text(found, too_many, "drop")), raw_path, dedupe_batch, table)

    query = start_query(lines, load, checkpoint, available_now=True)
    query.awaitTermination()
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]

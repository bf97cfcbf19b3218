"""CSV and Parquet files, and the month-partitioned raw table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from gradewise.schemas import CSV_NULLS, RAW_SCHEMA
from gradewise.session import observed


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files; the schema comes from the files."""
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the files at `path`."""
    df.write.mode("overwrite").parquet(path)


# Holds the text of a line that does not fit its header.
RECORD = "_record"


def _names(spark: SparkSession, path: str | list[str], options: dict) -> list[str]:
    return spark.read.options(**options).csv(path).columns


def _options(one_line_per_record: bool) -> dict:
    return {"header": True, "quote": '"', "escape": '"', "multiLine": not one_line_per_record}


def _lines(reader: DataFrameReader | DataStreamReader, names: list[str], path: str | list[str], options: dict) -> tuple[DataFrame, Column]:
    """The columns of CSV files as text and `_record`, and whether a line has more fields than the header."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, RECORD)])
    lines = (
        reader.options(**options).option("enforceSchema", False).option("columnPruning", False)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD).schema(schema).csv(path)
    )
    # The record is also kept of a line with too few fields, which is no fault. One more column tells them apart.
    wider = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names) + 1)])
    again = F.from_csv(F.col(RECORD), wider.simpleString()[7:-1].replace(":", " "), {
        "quote": '"', "escape": '"', "nullValue": "\u0001", "emptyValue": "",
    })
    surplus = F.col(RECORD).isNotNull() & again.getField(f"c{len(names)}").isNotNull()
    return lines, surplus


def _csv(spark: SparkSession, path: str | list[str], one_line_per_record: bool) -> tuple[DataFrame, Column]:
    options = _options(one_line_per_record)
    return _lines(spark.read, _names(spark, path, options), path, options)


def csv_stream(
    spark: SparkSession, folder: str, one_line_per_record: bool = False, files_per_batch: int | None = None
) -> tuple[DataFrame, Column]:
    """The lines of a folder's CSV files as a stream, each file once, and whether a line has too many fields.

    `loan_text` and `surplus_lines` take both. The header is that of the files now there. A file's age doesn't matter: by default Spark
    would pass over files much older than the newest.
    """
    options = _options(one_line_per_record)
    reader = spark.readStream.option("maxFileAge", "36500d")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _lines(reader, _names(spark, folder, options), folder, options)


def loan_text(lines: DataFrame, too_many: Column, surplus: str = "stop") -> DataFrame:
    """The columns of CSV lines, with missing-value marks as NULL; for `surplus` see `read_loans_csv`."""
    if surplus == "stop":
        stop = F.raise_error(F.concat(F.lit("more fields than the header has: "), F.col(RECORD))).cast("boolean")
        kept = lines.where(F.when(too_many, stop).otherwise(True))
    elif surplus == "drop":
        kept = lines.where(~too_many)
    else:
        raise ValueError(f"surplus must be 'stop' or 'drop', not {surplus!r}")
    names = [c for c in lines.columns if c != RECORD]
    return kept.select(*[F.when(~F.col(f"`{c}`").isin(CSV_NULLS), F.col(f"`{c}`")).alias(c) for c in names])


def surplus_lines(lines: DataFrame, too_many: Column) -> DataFrame:
    """The lines with too many fields, as text in `value`."""
    # Spark refuses to read the record alone.
    nothing = F.substring(F.coalesce(F.col(f"`{lines.columns[0]}`"), F.lit("")), 1, 0)
    return lines.where(too_many).select(F.concat(RECORD, nothing).alias("value"))


def read_loans_csv(
    spark: SparkSession, path: str | list[str], one_line_per_record: bool = False, surplus: str = "stop"
) -> DataFrame:
    """CSV files with a header; all columns are text, and missing-value marks become NULL.

    A line with too few fields is filled up with NULLs. One with more than the header has, as an unquoted
    comma makes it, would shift its fields: it stops the read, or with `surplus="drop"` is left out (see `csv_rejects`).
    A delimiter behind the last field, with nothing after it, shifts nothing and is no fault.

    Quoted fields may hold line breaks and doubled quotes. That makes a file one unit of
    work, so the input should come as many files. `one_line_per_record` lets Spark split
    files, for inputs known to hold no line breaks inside fields. Files whose header
    differs from the first one's stop the read, as columns go by position.
    """
    return loan_text(*_csv(spark, path, one_line_per_record), surplus)


def csv_rejects(spark: SparkSession, path: str | list[str], one_line_per_record: bool = False) -> DataFrame:
    """The lines with more fields than the header has, as text in `value`."""
    return surplus_lines(*_csv(spark, path, one_line_per_record))


def write_raw(loans: DataFrame, path: str, mode: str = "append") -> list[str | None]:
    """Write raw-schema rows partitioned by issue month, sorted by grade and status inside; returns the months written.

    `rebalance` brings a month's rows together in full-size files and splits a month too
    large for one task, such as that of the loans without a date. The sort lets a reader
    skip row groups by grade and status. The months are noted while the rows go by.
    """
    month = F.date_format("issue_date", "yyyy-MM")
    seen = Observation()
    (
        loans.withColumn("issue_month", month)
        .observe(seen, F.collect_set("issue_month").alias("months"), F.count_if(F.col("issue_month").isNull()).alias("undated"))
        .hint("rebalance", "issue_month")
        .sortWithinPartitions("issue_month", "grade", "loan_status")
        .write.mode(mode)
        .partitionBy("issue_month")
        .parquet(path)
    )
    noted = observed(seen)
    return sorted(noted.get("months", ())) + ([None] if noted.get("undated") else [])


def read_raw(
    spark: SparkSession,
    path: str,
    issued_from: dt.date | None = None,
    issued_to: dt.date | None = None,
) -> DataFrame:
    """Raw table, optionally between two issue dates (inclusive).

    A date range is also put on the partition column, so only its months are listed and read.
    """
    stored = T.StructType([*RAW_SCHEMA, T.StructField("issue_month", T.StringType())])
    raw = spark.read.schema(stored).parquet(path)
    if issued_from is not None:
        raw = raw.where(
            (F.col("issue_month") >= issued_from.strftime("%Y-%m")) & (F.col("issue_date") >= F.lit(issued_from))
        )
    if issued_to is not None:
        raw = raw.where(
            (F.col("issue_month") <= issued_to.strftime("%Y-%m")) & (F.col("issue_date") <= F.lit(issued_to))
        )
    return raw.drop("issue_month")


def save_results(results: dict[str, DataFrame], out: str, names: Iterable[str] | None = None) -> dict[str, str]:
    """Write each result set to its own folder under `out`, replacing it; returns the paths."""
    paths = {}
    for name in names or results:
        paths[name] = f"{out.rstrip('/')}/{name}"
        write_parquet(results[name], paths[name])
    return paths

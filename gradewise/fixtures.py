"""Loans and loan events derived from the test tables, for queries, tests and the bench.

Everything follows from whole tables by rule, so it grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewise.functions import risk_tier
from gradewise.plans.ingest import to_raw_schema
from gradewise.schemas import SOURCE_COLUMNS


# Loan columns by rule, from an order (key k) and its customer.
_LOAN_RULES = {
    "id": "if(k % 97 != 96, cast(k as string), null)",
    "loan_amnt": "o_totalprice",
    "funded_amnt": "if(k % 101 = 100, 0D, o_totalprice * 0.75D)",
    "grade": "substring('ABCDEFGH', nullif(cast(k % 9 as int), 8) + 1, 1)",
    "sub_grade": "concat(substring('ABCDEFGH', nullif(cast(k % 9 as int), 8) + 1, 1), k % 5 + 1)",
    "int_rate": "if(k % 89 = 88, 'n/a', concat(k % 20 + 5, '.', lpad(cast(k * 37 % 100 as string), 2, '0'), '%'))",
    "loan_status": """case k % 8 when 0 then 'Fully Paid' when 1 then 'Charged Off' when 2 then 'Current'
        when 3 then 'Default' when 4 then 'Does not meet the credit policy. Status:Charged Off'
        when 5 then 'charged off' when 6 then 'Fully Paid' end""",
    "issue_d": """case when k % 83 = 82 then 'junk' when k % 3 = 0 then date_format(o_orderdate, 'MMM-yy')
        else date_format(o_orderdate, 'MMM-yyyy') end""",
    "purpose": "c_mktsegment",
    "addr_state": "cast(c_nationkey as string)",
    "mths_since_last_delinq": "if(k % 3 = 0, null, k % 130)",
    "total_pymnt": "o_totalprice * 0.5D",
    "out_prncp": "o_totalprice - o_totalprice * 0.5D",
    "delinq_2yrs": "if(k % 4 = 0, null, k % 5)",
    "annual_inc": "c_acctbal",
    "dti": "(k % 4000) / 100D",
    "ingest_ts": "o_orderdate",
    "k": "k",
}


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loan per order, as text-heavy as a source file: percent signs, month names, junk."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumnRenamed("o_orderkey", "k")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return joined.selectExpr(*[f"{rule} AS {name}" for name, rule in _LOAN_RULES.items()])


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loans in the raw schema (rows without an id are gone)."""
    return to_raw_schema(loans(spark, sf_dir), ingest_ts=F.col("ingest_ts"))


def csv_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loans with a source file's columns only."""
    return loans(spark, sf_dir).select(*SOURCE_COLUMNS)


def _as_loan_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("event_id").cast("string").alias("loan_id"),
        F.col("event_type").alias("grade"),
        F.col("value").alias("loan_amount"),
        F.col("value").alias("interest_rate"),
        F.when(F.col("event_type") == "error", F.lit("Default")).otherwise(F.lit("Current")).alias("loan_status"),
        F.when(F.col("value") > 50, F.floor("value").cast("int")).alias("mths_since_last_delinq"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )


def loan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loan event per row of the events table."""
    return _as_loan_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def loan_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events, as a stream."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    # A file stream reads folders; as a pattern, of this very name, the path may be a folder or one file.
    return _as_loan_events(spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages of all ten fields from the events table, five in eight of them odd or broken."""
    event = loan_events(spark, sf_dir)
    kind = F.col("event_id") % 8
    whole = F.to_json(F.struct(
        "loan_id", "grade", "loan_amount", "interest_rate", "loan_status",
        F.date_format("event_time", "yyyy-MM-dd").alias("issue_date"), "mths_since_last_delinq",
        (F.col("loan_amount") * 0.5).alias("total_payment"), (F.col("loan_amount") * 0.25).alias("outstanding_principal"),
        risk_tier(F.col("grade")).alias("risk_tier"),
    ))
    more = F.concat(F.expr("substring(value, 1, length(value) - 1)"), F.lit(', "channel": "web"}'))
    return event.select("event_id", whole.alias("value")).select(
        "event_id",
        F.when(kind == 1, more)
        .when(kind == 2, F.regexp_replace("value", '"loan_amount":[^,]*,', '"loan_amount":"lots",'))
        .when(kind == 3, F.lit("not json"))
        .when(kind == 4, F.lit("{}"))
        .when(kind == 5, F.lit(None).cast("string"))
        .when(kind == 6, F.lit("[1]"))
        .otherwise(F.col("value"))
        .alias("value"),
    )


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loans as lines of text without a header, every seventh with one field too many; `k`, `value`."""
    rows = loans(spark, sf_dir)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SOURCE_COLUMNS]
    extra = F.when(F.col("k") % 7 == 0, F.lit(",EXTRA")).otherwise("")
    return rows.select("k", F.concat(F.concat_ws(",", *fields), extra).alias("value"))

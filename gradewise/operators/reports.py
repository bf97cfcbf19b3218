"""Portfolio reports.

All reports are cut from one additive tally: counts and sums per key, which can be added
up again to any coarser key. A run that needs every report tallies the loans once by all
keys together (`portfolio_cube`) and cuts the reports from that small result, so the loans
are scanned once and nothing of their size is cached or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gradewise.functions import (
    bucket_label,
    default_flag,
    dpd_bucket,
    month_of,
    percent_to_double,
    risk_tier,
    round_stable,
)

CUBE_KEYS = ("grade", "risk_tier", "issue_month", "dpd_bucket")
_TALLIES = ("n_loans", "n_defaults", "volume", "rate_sum", "rate_n")


def clean_rate(loans: DataFrame, column: str = "int_rate") -> DataFrame:
    """The rate column as double. A column that is a number already is not parsed again."""
    if dict(loans.dtypes)[column] == "double":
        return loans
    return loans.withColumn(column, percent_to_double(F.col(column)))


def enrich(loans: DataFrame, ts: str = "ingest_ts") -> DataFrame:
    """Raw or file-level loans with the columns the reports group by."""
    return clean_rate(loans).withColumns({
        "is_defaulted": default_flag(F.col("loan_status")).cast("int"),
        "risk_tier": risk_tier(F.col("grade")),
        "issue_month": month_of(F.col(ts)),
        "dpd_bucket": dpd_bucket(F.col("mths_since_last_delinq")),
    })


def tally(enriched: DataFrame, *keys: str) -> DataFrame:
    """Counts and sums of enriched loans per key; partial sums are built before the shuffle."""
    return enriched.groupBy(*keys).agg(
        F.count("*").alias("n_loans"),
        F.sum("is_defaulted").alias("n_defaults"),
        F.sum("loan_amnt").alias("volume"),
        F.sum("int_rate").alias("rate_sum"),
        F.count("int_rate").alias("rate_n"),
    )


def portfolio_cube(loans: DataFrame, ts: str = "ingest_ts") -> DataFrame:
    """Tally by grade, tier, month and bucket: the one pass all four reports share."""
    return tally(enrich(loans, ts), *CUBE_KEYS)


def merged_cube(cubes: DataFrame) -> DataFrame:
    """One cube from the rows of several, such as those of single loads."""
    return cubes.groupBy(*CUBE_KEYS).agg(*[F.sum(c).alias(c) for c in _TALLIES])


def _by(source: DataFrame, key: str, ts: str = "ingest_ts") -> DataFrame:
    """A tally per key, from a cube or from loans."""
    if "n_loans" in source.columns:
        return source.groupBy(key).agg(*[F.sum(c).alias(c) for c in _TALLIES])
    return tally(enrich(source, ts), key)


def _percent(part: Column, whole: Column, digits: int) -> Column:
    return round_stable(F.try_divide(part * F.lit(100.0), whole), digits)


def _default_rate() -> Column:
    return _percent(F.col("n_defaults"), F.col("n_loans"), 2).alias("default_rate_pct")


def _mean_rate() -> Column:
    mean = F.try_divide(F.col("rate_sum"), F.col("rate_n"))
    return round_stable(mean, 2).alias("avg_interest_rate")


def _volume() -> Column:
    return round_stable(F.col("volume"), 2).alias("total_volume_usd")


def default_rate_by_grade(source: DataFrame) -> DataFrame:
    """Loans, defaults, default rate and mean interest rate per grade."""
    return _by(source, "grade").select(
        "grade",
        F.col("n_loans").alias("total_loans"),
        F.col("n_defaults").alias("total_defaults"),
        _default_rate(),
        _mean_rate(),
    ).orderBy("grade")


def monthly_volume(source: DataFrame, ts: str = "ingest_ts") -> DataFrame:
    """Loans, lent volume and mean interest rate per month of the load timestamp, or of `ts`.

    A cube has its months already; there `ts` was chosen when it was built.
    """
    return _by(source, "issue_month", ts).select(
        "issue_month", F.col("n_loans").alias("total_loans"), _volume(), _mean_rate()
    ).orderBy("issue_month")


def dpd_distribution(source: DataFrame) -> DataFrame:
    """Loans per delinquency bucket and their share of all loans."""
    buckets = _by(source, "dpd_bucket")
    # The total is taken over the five buckets, never over the loans.
    total = F.sum("n_loans").over(Window.partitionBy())
    return buckets.select(
        F.col("dpd_bucket").alias("bucket"),
        F.col("n_loans").alias("total_loans"),
        _percent(F.col("n_loans"), total, 1).alias("pct"),
    ).orderBy("bucket").select(bucket_label(F.col("bucket")).alias("dpd_bucket"), "total_loans", "pct")


def risk_tier_summary(source: DataFrame) -> DataFrame:
    """Loans, default rate and lent volume per risk tier."""
    return _by(source, "risk_tier").select(
        "risk_tier", F.col("n_loans").alias("total_loans"), _default_rate(), _volume()
    ).orderBy("risk_tier")


def row_count(loans: DataFrame) -> DataFrame:
    """Number of loans, as a one-row frame."""
    return loans.agg(F.count("*").alias("total_rows"))


def portfolio_kpis(mart: DataFrame) -> DataFrame:
    """Headline figures, from the mart's few rows.

    Gives the default rate twice: weighted by loans, and as the plain mean over the
    mart's rows, which is what an average over the mart column shows.
    """
    defaults, loans = F.sum("total_defaults"), F.sum("total_loans")
    low_risk = F.sum(F.when(F.col("risk_tier") == "Low Risk", F.col("total_loans")).otherwise(0))
    return mart.agg(
        loans.alias("total_loans"),
        round_stable(F.sum("total_loan_volume"), 2).alias("total_volume_usd"),
        _percent(defaults, loans, 2).alias("default_rate_pct"),
        round_stable(F.avg("default_rate_pct"), 2).alias("mean_grade_default_rate_pct"),
        _percent(low_risk, loans, 1).alias("low_risk_share_pct"),
    )


def tier_share(mart: DataFrame) -> DataFrame:
    """Share of all loans per risk tier, from the mart's few rows."""
    tiers = mart.groupBy("risk_tier").agg(F.sum("total_loans").alias("total_loans"))
    total = F.sum("total_loans").over(Window.partitionBy())
    return tiers.select(
        "risk_tier", "total_loans", _percent(F.col("total_loans"), total, 1).alias("share_pct")
    ).orderBy("risk_tier")

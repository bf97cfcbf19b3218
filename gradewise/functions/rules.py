"""Business rules of the loan data model as Column expressions.

Each function takes and returns a Column. Messy text turns into NULL through try_ casts,
because a plain cast stops the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradewise.functions.rounding import round_stable
from gradewise.schemas import (
    DEFAULTED_STATUSES,
    DPD_BEYOND,
    DPD_CURRENT,
    DPD_UP_TO,
    RISK_TIERS,
    UNKNOWN,
)


def percent_to_double(rate: Column) -> Column:
    """`10.65%`, `10.65` or a number as double; anything else is NULL."""
    return F.replace(rate.cast("string"), F.lit("%"), F.lit("")).try_cast("double")


def default_flag(status: Column, case_sensitive: bool = False) -> Column:
    """True for the statuses of a loan gone bad, false for all others and for NULL."""
    if case_sensitive:
        gone_bad = status.isin(DEFAULTED_STATUSES)
    else:
        gone_bad = F.lower(status).isin([s.lower() for s in DEFAULTED_STATUSES])
    return F.coalesce(gone_bad, F.lit(False))


def risk_tier(grade: Column) -> Column:
    """Risk tier of a grade; unlisted and NULL grades are `Unknown`."""
    matches = [F.when(grade.isin(grades), F.lit(tier)) for tier, grades in RISK_TIERS.items()]
    return F.coalesce(*matches, F.lit(UNKNOWN))


def dpd_bucket(months: Column) -> Column:
    """Delinquency bucket with its sort prefix.

    NULL and text that is no number count as 0; negative numbers fall into the first
    past-due bucket and NaN into the last.
    """
    number = F.coalesce(months.try_cast("double"), F.lit(0.0))
    bucket = F.when(number == 0, F.lit(DPD_CURRENT))
    for upper, label in DPD_UP_TO:
        bucket = bucket.when(number <= upper, F.lit(label))
    return bucket.otherwise(F.lit(DPD_BEYOND))


def bucket_label(bucket: Column) -> Column:
    """Bucket name without its two-character sort prefix."""
    return F.substring(bucket, 3, 100)


def parse_issue_month(text: Column) -> Column:
    """`Dec-2011` or `Dec-11` as the first day of that month; anything else is NULL.

    Two-digit years from 69 on belong to the 1900s; Spark alone would read all of them
    as 20xx. The text's length picks the format, as trying one after the other means a
    costly parse failure for every row in the other form.
    """
    text = text.cast("string")
    short = F.try_to_date(text, "MMM-yy")
    pivoted = F.when(F.year(short) >= 2069, F.add_months(short, -1200)).otherwise(short)
    length = F.length(text)
    return F.when(length == 8, F.try_to_date(text, "MMM-yyyy")).when(length == 6, pivoted)


def row_hash(loan_id: Column) -> Column:
    """Hex MD5 of the id's text, the key of the insert-only merge."""
    return F.md5(loan_id.cast("string"))


def repayment_rate_pct(paid: Column, funded: Column) -> Column:
    """Share of the funded amount paid back, in percent; NULL where nothing was funded."""
    return round_stable(F.try_divide(paid, funded) * 100, 2)


def month_of(ts: Column) -> Column:
    """Start of the month a timestamp falls into."""
    return F.date_trunc("month", ts.cast("timestamp"))


def is_delinquent_event(status: Column, months: Column) -> Column:
    """Event of a defaulted loan (exact spelling of the status) or one once delinquent.

    A filter predicate: it may be NULL, which a filter takes for false, and is left bare of
    coalesce so that it reaches the Parquet scan.
    """
    return status.isin(DEFAULTED_STATUSES) | (months > 0)


def has_delinquency(months: Column) -> Column:
    """True where a positive number of months is known."""
    return F.coalesce(months > 0, F.lit(False))


def grade_or_unknown(grade: Column) -> Column:
    """Grade with NULL spelled out."""
    return F.coalesce(grade, F.lit(UNKNOWN))

"""Column expressions: rules, parsing and rounding. All of them run inside codegen."""

from gradewise.functions.rounding import round_stable
from gradewise.functions.rules import (
    bucket_label,
    default_flag,
    dpd_bucket,
    grade_or_unknown,
    has_delinquency,
    is_delinquent_event,
    month_of,
    parse_issue_month,
    percent_to_double,
    repayment_rate_pct,
    risk_tier,
    row_hash,
)

__all__ = [
    "bucket_label",
    "default_flag",
    "dpd_bucket",
    "grade_or_unknown",
    "has_delinquency",
    "is_delinquent_event",
    "month_of",
    "parse_issue_month",
    "percent_to_double",
    "repayment_rate_pct",
    "risk_tier",
    "round_stable",
    "row_hash",
]

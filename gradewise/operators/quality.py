"""Declarative data checks. Each check returns its failures as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gradewise.schemas import RISK_TIERS, UNKNOWN
from gradewise.session import observed


class QualityError(RuntimeError):
    """Raised when a required check has failures."""


@dataclass(frozen=True)
class Check:
    """One check of one column: `unique`, `not_null` or `accepted_values`."""

    kind: str
    column: str
    values: Sequence[str] = field(default=())

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.column}"

    def violated(self) -> Column:
        """Row predicate of a check that needs no grouping."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        if self.kind == "accepted_values":
            return ~F.col(self.column).isin(*self.values)
        raise ValueError(f"{self.kind} is not a row check")


# The checks of the staging model.
STAGING_CHECKS = [
    Check("unique", "loan_id"),
    Check("not_null", "loan_id"),
    Check("not_null", "grade"),
    Check("not_null", "loan_status"),
    Check("accepted_values", "risk_tier", [*RISK_TIERS, UNKNOWN]),
]


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows; NULL is ignored."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    return counted.where("n_records > 1")


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.where(Check("not_null", column).violated())


def check_accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the accepted ones, with their number of rows; NULL passes."""
    outside = df.where(Check("accepted_values", column, values).violated())
    return outside.groupBy(column).agg(F.count("*").alias("n_records"))


def _row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Failures of all row checks, from one pass over the rows.

    A column whose values are checked becomes a pair (check, value) if the value is outside, so the pass sends on, for each check, its
    failures' counts and its different offending values, and never combinations of columns.
    """
    by_value = [c for c in checks if c.kind == "accepted_values"]
    nulls = [c for c in checks if c.kind == "not_null"]
    missing = {c.name: F.coalesce(F.sum(f"_{c.name}"), F.lit(0)).alias(c.name) for c in nulls}
    if not by_value:
        counted = df.select(*[c.violated().cast("int").alias(f"_{c.name}") for c in nulls]).agg(*missing.values())
    else:
        # Each row gives one row for its nulls, and one for each value outside.
        none = F.lit(None).cast("string")
        outside = [F.struct(F.when(c.violated(), F.lit(c.name)).alias("check"), F.col(c.column).cast("string").alias("value")) for c in by_value]
        entries = F.concat(
            F.array(F.struct(none.alias("check"), none.alias("value"))), F.filter(F.array(*outside), lambda e: e["check"].isNotNull()),
        )
        found = df.select(*[c.violated().cast("int").alias(f"_{c.name}") for c in nulls], F.explode(entries).alias("_entry"))
        first = F.col("_entry.check").isNull()
        sums = [F.sum(F.when(first, F.col(f"_{c.name}"))).alias(f"_{c.name}") for c in nulls]
        tallies = found.groupBy("_entry").agg(*sums) if sums else found.distinct()
        counted = tallies.agg(*missing.values(), *[F.count_if(F.col("_entry.check") == c.name).alias(c.name) for c in by_value])
    rows = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.lit(c.column).alias("column_name"),
            F.col(c.name).alias("failures"),
        )
        for c in checks
    ]
    return counted.select(F.inline(F.array(*rows)))


def run_checks(df: DataFrame, checks: Sequence[Check] = STAGING_CHECKS) -> DataFrame:
    """Failures per check: `check_name, column_name, failures`.

    Not-null failures count rows; unique and accepted-values failures count the offending
    values. All row checks share one pass; each uniqueness check adds a pass over its own
    column alone.
    """
    row_checks = [c for c in checks if c.kind != "unique"]
    parts = [_row_checks(df, row_checks)] if row_checks else []
    for check in checks:
        if check.kind == "unique":
            failures = check_unique(df, check.column).agg(F.count("*").alias("failures"))
            name, column = F.lit(check.name).alias("check_name"), F.lit(check.column).alias("column_name")
            parts.append(failures.select(name, column, "failures"))
    return reduce(DataFrame.unionByName, parts)


REPORT = "check_name string, column_name string, failures bigint"


class WatchedChecks:
    """The checks of rows that are being written: counted while they go by, in place of a scan of their own.

    `watch` the frame before its write, and ask for the `report` behind it. Row checks cost nothing then. A uniqueness check reads its
    column of what was written, and so does an accepted-values check that has failed, whose different values are to be counted.
    Either is a scan of one stored column, not of the source.
    """

    def __init__(self, checks: Sequence[Check] = STAGING_CHECKS):
        self.checks = checks
        self._seen = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        counts = [F.count_if(c.violated()).alias(c.name) for c in self.checks if c.kind != "unique"]
        return df.observe(self._seen, F.count("*").alias("rows"), *counts)

    def report(self, written: DataFrame) -> DataFrame:
        """Failures per check as `run_checks` gives them, of the rows that were watched and now are `written`."""
        seen = observed(self._seen)
        again = [c for c in self.checks if c.kind == "unique" or c.kind == "accepted_values" and seen.get(c.name)]
        failures = {c.name: seen.get(c.name, 0) for c in self.checks}
        if again:
            failures |= {r["check_name"]: r["failures"] for r in run_checks(written, again).collect()}
        rows = [(c.name, c.column, failures[c.name]) for c in self.checks]
        return written.sparkSession.createDataFrame(rows, REPORT)


def raise_failures(report: DataFrame) -> DataFrame:
    """The report, which has one row per check, unless it has failures: then QualityError."""
    failed = {r["check_name"]: r["failures"] for r in report.collect() if r["failures"]}
    if failed:
        raise QualityError(f"data checks failed: {failed}")
    return report


def require_passing(df: DataFrame, checks: Sequence[Check] = STAGING_CHECKS) -> DataFrame:
    """Run the checks and raise QualityError if any of them fails; returns the report."""
    return raise_failures(df.sparkSession.createDataFrame(run_checks(df, checks).collect(), REPORT))

"""Models kept up to date month by month.

The loan facts are stored by issue month (`core.fct_loans_by_month`). A refresh rebuilds the months that have changed, in place of
all; the others keep their files. Loads only ever add rows, so a month has changed if the raw table has more of its rows than the facts,
which takes no column of either: the numbers of rows stand in the files' footers. A refresh that dies is repaired by the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewise.operators.quality import WatchedChecks, raise_failures
from gradewise.plans.models import fct_loans, mart_loan_risk, stg_loans
from gradewise.sources import tables

MONTH = "issue_month"
FACTS = "core.fct_loans_by_month"


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy(MONTH).agg(F.count("*").alias("n"))


def changed_months(spark: SparkSession) -> list[str | None]:
    """Months whose rows in `raw.loans_raw` are not all among the stored facts, None for loans without a date.

    A list on the driver: a table has few months.
    """
    raw = _sizes(tables.source(spark, "raw", "loans_raw"))
    if spark.catalog.tableExists(FACTS):
        have = _sizes(spark.table(FACTS)).select(F.col(MONTH).alias("_month"), F.col("n").alias("_n"))
        raw = raw.join(have, F.col(MONTH).eqNullSafe(F.col("_month")), "left").where(~F.col("n").eqNullSafe(F.col("_n")))
    return sorted((r[MONTH] for r in raw.collect()), key=lambda m: (m is None, m))


def _among(months: list[str | None]) -> Column:
    named = F.col(MONTH).isin([m for m in months if m is not None])
    return named | F.col(MONTH).isNull() if None in months else named


def refresh_models(spark: SparkSession, months: list[str | None] | None = None, check: bool | str = True) -> dict:
    """Rebuild the facts of the changed (or given) months and the mart; returns `months`, the models and the check `report`.

    Reads `raw.loans_raw` (see `tables.register_raw`), and of it the folders of those months only. The row checks watch the rebuilt rows, the
    uniqueness check reads its column of all facts. For `check` see `build_models`.
    """
    if months is None:
        months = changed_months(spark)
    watched = WatchedChecks()
    if months:
        raw = tables.source(spark, "raw", "loans_raw").where(_among(months))
        facts = watched.watch(fct_loans(stg_loans(raw))).withColumn(MONTH, F.date_format("issue_date", "yyyy-MM"))
        facts = facts.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "grade", "loan_status")
        if spark.catalog.tableExists(FACTS):
            # By path, since a table's insert takes the mode from the session alone.
            facts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(tables.location(spark, FACTS))
            tables.add_months(spark, FACTS, months, MONTH)
        else:
            facts.write.partitionBy(MONTH).format("parquet").saveAsTable(FACTS)
    stored = spark.table(FACTS).drop(MONTH)
    mart = tables.materialize(mart_loan_risk(stored), "mart_loan_risk", "table", layer="mart") if months else tables.source(spark, "mart", "mart_loan_risk")
    built = {"months": months, "fct_loans": stored, "mart_loan_risk": mart}
    if check and months:
        report = watched.report(stored)
        built["report"] = report if check == "report" else raise_failures(report)
    return built

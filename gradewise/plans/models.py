"""The three model layers: staged loans, loan facts and the risk mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewise.functions import default_flag, repayment_rate_pct, risk_tier, round_stable
from gradewise.operators.quality import WatchedChecks, raise_failures
from gradewise.schemas import RISK_TIERS, UNKNOWN
from gradewise.sources import tables

# Business names of the staged columns and the raw columns they come from.
STAGED = {
    "loan_id": "id",
    "loan_amount": "loan_amnt",
    "funded_amount": "funded_amnt",
    "grade": "grade",
    "sub_grade": "sub_grade",
    "interest_rate": "int_rate",
    "loan_status": "loan_status",
    "issue_date": "issue_date",
    "purpose": "purpose",
    "state": "addr_state",
    "mths_since_last_delinq": "mths_since_last_delinq",
    "total_payment": "total_pymnt",
    "outstanding_principal": "out_prncp",
    "delinq_2yrs": "delinq_2yrs",
    "annual_income": "annual_inc",
    "dti": "dti",
    "ingest_ts": "ingest_ts",
    "row_hash": "row_hash",
}
COUNTERS = ["mths_since_last_delinq", "delinq_2yrs"]


def stg_loans(raw: DataFrame) -> DataFrame:
    """Raw loans with an id, under business names; missing counters are 0."""
    columns = [F.col(old).alias(new) for new, old in STAGED.items()]
    return (
        raw.where(F.col("id").isNotNull())
        .select(*columns, risk_tier(F.col("grade")).alias("risk_tier"))
        .fillna(0, subset=COUNTERS)
    )


def stg_loans_sql(raw_table: str) -> str:
    """The same model as SQL text, for a view that the catalog keeps."""
    columns = [f"coalesce({old}, 0L) AS {new}" if new in COUNTERS else f"{old} AS {new}" for new, old in STAGED.items()]
    tiers = " ".join(
        f"WHEN grade IN ({', '.join(repr(g) for g in grades)}) THEN '{tier}'" for tier, grades in RISK_TIERS.items()
    )
    return f"SELECT {', '.join(columns)}, CASE {tiers} ELSE '{UNKNOWN}' END AS risk_tier FROM {raw_table} WHERE id IS NOT NULL"


def fct_loans(staged: DataFrame) -> DataFrame:
    """Staged loans with repayment rate and default flag."""
    return staged.withColumns({
        "repayment_rate_pct": repayment_rate_pct(F.col("total_payment"), F.col("funded_amount")),
        "is_defaulted": default_flag(F.col("loan_status")),
    })


def mart_loan_risk(facts: DataFrame) -> DataFrame:
    """Risk figures per grade and tier. The output names are fixed values."""

    def mean(column: str):
        return round_stable(F.avg(column), 2)

    defaults = F.count_if(F.col("is_defaulted"))
    return (
        facts.groupBy("grade", "risk_tier")
        .agg(
            F.count("*").alias("total_loans"),
            mean("interest_rate").alias("avg_interest_rate"),
            mean("dti").alias("avg_dti"),
            mean("annual_income").alias("avg_annual_income"),
            mean("loan_amount").alias("avg_loan_amount"),
            F.sum("loan_amount").alias("total_loan_volume"),
            mean("repayment_rate_pct").alias("avg_repayment_rate_pct"),
            defaults.alias("total_defaults"),
            round_stable(defaults * F.lit(100.0) / F.count("*"), 2).alias("default_rate_pct"),
        )
        .orderBy("grade")
    )


def build_models(spark: SparkSession, raw: DataFrame | None = None, check: bool | str = True) -> dict[str, DataFrame]:
    """Build all layers in order and check the staged rows; returns the published models, and the check `report`.

    Without `raw` the models read the catalog's `raw.loans_raw` (see `tables.register_raw`), and
    `staging.stg_loans` is a stored view that any session can read; of a DataFrame it is a session view. Either way
    Spark folds it into the scan behind the fact table, which is stored and feeds the mart. The checks watch the rows on their way
    into the fact table, so the raw loans are read once. A failed check raises QualityError after the
    build, or with `check="report"` is left to the caller; `check=False` leaves the checks out.
    """
    if raw is None:
        staged = tables.stored_view(spark, "staging", "stg_loans", stg_loans_sql("`raw`.`loans_raw`"))
    else:
        staged = tables.materialize(stg_loans(raw), "stg_loans", "view")
    watched = WatchedChecks()
    facts = fct_loans(staged)
    facts = tables.materialize(watched.watch(facts) if check else facts, "fct_loans", "table", layer="core")
    mart = tables.materialize(mart_loan_risk(facts), "mart_loan_risk", "table", layer="mart")
    models = {"stg_loans": staged, "fct_loans": facts, "mart_loan_risk": mart}
    if check:
        report = watched.report(facts)
        models["report"] = report if check == "report" else raise_failures(report)
    return models

"""Dashboard tiles, all answered from the mart's few rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gradewise.operators.reports import portfolio_kpis, tier_share


def tiles(mart: DataFrame) -> dict[str, DataFrame]:
    """Scorecards, share per tier, and the default and interest rates per grade."""
    by_grade = mart.select("grade", "default_rate_pct", "avg_interest_rate", "total_loans").orderBy("grade")
    return {"scorecards": portfolio_kpis(mart), "tier_share": tier_share(mart), "rates_by_grade": by_grade}

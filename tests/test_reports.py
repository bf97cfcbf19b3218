"""Reports: from the cube and from loans alike, in one pass."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gradewise.operators import reports
from gradewise.plans.dashboard import tiles
from gradewise.plans.models import fct_loans, mart_loan_risk, stg_loans
from gradewise.plans.report import REPORTS, add_load, report_frames, report_loads, run_report


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_cube_and_loans_give_the_same_reports(loans):
    cube = reports.portfolio_cube(loans).cache()
    for name, report in REPORTS.items():
        assert rows(report(cube)) == rows(report(loans)), name


def test_reports_are_ordered(loans):
    grades = [r["grade"] for r in reports.default_rate_by_grade(loans).collect()]
    assert grades == [None, *"ABCDEFGH"]
    buckets = [r["dpd_bucket"] for r in reports.dpd_distribution(loans).collect()]
    assert buckets == ["Current", "DPD 1-30", "DPD 31-60", "DPD 61-90", "DPD 90+"]


def test_shares_and_totals_add_up(loans, raw):
    n = loans.count()
    for report in (reports.default_rate_by_grade, reports.monthly_volume, reports.risk_tier_summary):
        assert report(loans).agg(F.sum("total_loans")).first()[0] == n
    shares = reports.dpd_distribution(loans).agg(F.sum("pct")).first()[0]
    assert shares == pytest.approx(100, abs=0.3)
    mart = mart_loan_risk(fct_loans(stg_loans(raw)))
    assert tiles(mart)["tier_share"].agg(F.sum("share_pct")).first()[0] == pytest.approx(100, abs=0.2)


def test_known_figures(spark):
    loans = spark.createDataFrame(
        [("A", "Charged Off", "10%", 100.0, 0), ("A", "Current", "20.5%", 50.0, 40),
         ("B", "Fully Paid", "n/a", 25.0, None), ("G", "default", None, 1.0, 95)],
        "grade string, loan_status string, int_rate string, loan_amnt double, mths_since_last_delinq int",
    ).withColumn("ingest_ts", F.lit("2024-05-06 07:08:09").cast("timestamp"))
    assert rows(reports.default_rate_by_grade(loans)) == [
        ("A", 2, 1, 50.0, 15.25), ("B", 1, 0, 0.0, None), ("G", 1, 1, 100.0, None),
    ]
    assert rows(reports.risk_tier_summary(loans)) == [
        ("High Risk", 1, 100.0, 1.0), ("Low Risk", 3, 33.33, 175.0),
    ]
    assert rows(reports.dpd_distribution(loans)) == [
        ("Current", 2, 50.0), ("DPD 31-60", 1, 25.0), ("DPD 90+", 1, 25.0),
    ]
    assert rows(reports.monthly_volume(loans).select("total_loans", "total_volume_usd", "avg_interest_rate")) == [
        (4, 176.0, 15.25),
    ]


def test_months_of_another_timestamp(loans):
    shifted = loans.withColumn("paid_at", F.lit("2020-02-03").cast("timestamp"))
    assert rows(reports.monthly_volume(shifted, ts="paid_at").select("total_loans")) == [(loans.count(),)]


def test_empty_portfolio(loans):
    empty = loans.limit(0)
    assert rows(reports.default_rate_by_grade(empty)) == []
    assert rows(reports.dpd_distribution(empty)) == []
    assert rows(reports.row_count(empty)) == [(0,)]


def test_scan_reads_only_what_a_report_needs(spark, loans, tmp_path, plan):
    path = str(tmp_path / "loans")
    loans.write.parquet(path)
    text = plan(reports.risk_tier_summary(spark.read.parquet(path)))
    schema = text.split("ReadSchema: ")[1].splitlines()[0]
    assert "loan_amnt" in schema and "grade" in schema and "loan_status" in schema
    for unused in ("purpose", "addr_state", "annual_inc", "total_pymnt"):
        assert unused not in schema


def test_report_job(spark, loans, tmp_path):
    path, out = str(tmp_path / "loans"), str(tmp_path / "out")
    loans.write.parquet(path)
    saved = run_report(spark, path, out)
    assert set(saved) == set(REPORTS)
    for name, frame in report_frames(loans).items():
        assert sorted(rows(saved[name]), key=str) == sorted(rows(frame), key=str), name
    again = run_report(spark, path, out)  # replaces
    assert again["default_by_grade"].count() == 9


def test_cube_of_loads_equals_one_cube(spark, loans, tmp_path):
    cubes = str(tmp_path / "cubes")
    for load in range(3):
        for _ in range(2 if load == 1 else 1):  # a load that is run again replaces itself
            add_load(loans.where(F.col("k") % 3 == load), cubes, f"l{load}")
    merged = reports.merged_cube(spark.read.parquet(cubes))
    want = reports.portfolio_cube(loans)
    exact = ["grade", "risk_tier", "issue_month", "dpd_bucket", "n_loans", "n_defaults", "rate_n"]
    assert merged.columns == want.columns
    assert merged.select(exact).exceptAll(want.select(exact)).isEmpty() and want.select(exact).exceptAll(merged.select(exact)).isEmpty()
    told = report_loads(spark, cubes, str(tmp_path / "report"))
    whole = reports.default_rate_by_grade(loans)
    assert told["default_by_grade"].exceptAll(whole).isEmpty() and told["default_by_grade"].count() == whole.count()
    with pytest.raises(ValueError):
        add_load(loans, cubes, "a/b")

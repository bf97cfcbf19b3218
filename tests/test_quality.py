"""Data checks on good and spoiled models."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gradewise.operators import quality
from gradewise.plans.models import stg_loans


@pytest.fixture(scope="module")
def good(raw):
    return stg_loans(raw).where("grade is not null and loan_status is not null").cache()


def failures(df, checks=quality.STAGING_CHECKS):
    return {r["check_name"]: r["failures"] for r in quality.run_checks(df, checks).collect()}


def test_good_model_passes(good):
    counts = failures(good)
    assert len(counts) == 5 and not any(counts.values())
    assert quality.require_passing(good).count() == 5


def test_spoiled_model_is_counted_exactly(good):
    n = good.count()
    copies = good.limit(7)
    spoiled = good.union(copies).union(copies).withColumns({
        "grade": F.when(F.col("grade") != "B", F.col("grade")),
        "risk_tier": F.when(F.col("risk_tier") == "High Risk", F.lit("Severe")).otherwise(F.col("risk_tier")),
    })
    no_id = good.limit(3).withColumn("loan_id", F.lit(None).cast("string"))
    counts = failures(spoiled.union(no_id))
    b_grades = spoiled.where("grade is null").count() + 0
    assert counts["unique_loan_id"] == 7
    assert counts["not_null_loan_id"] == 3
    assert counts["not_null_grade"] == b_grades
    assert counts["not_null_loan_status"] == 0
    assert counts["accepted_values_risk_tier"] == 1
    assert n + 14 == spoiled.count()
    with pytest.raises(quality.QualityError, match="unique_loan_id"):
        quality.require_passing(spoiled)


def test_failing_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "x string")
    assert [tuple(r) for r in quality.check_unique(df, "x").collect()] == [("a", 2)]
    assert quality.check_not_null(df, "x").count() == 2
    assert [tuple(r) for r in quality.check_accepted(df, "x", ["a"]).collect()] == [("b", 1)]


def test_checks_of_other_columns(good):
    """The same operators with other parameters."""
    checks = [
        quality.Check("accepted_values", "grade", list("ABCDEFG")),
        quality.Check("not_null", "loan_amount"),
    ]
    assert failures(good, checks) == {"accepted_values_grade": 1, "not_null_loan_amount": 0}


def test_row_checks_shuffle_only_partial_counts(spark, good, plan, tmp_path):
    good.write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    text = plan(quality.run_checks(stored, [quality.Check("not_null", c) for c in ("grade", "loan_id")]))
    assert text.count("Exchange") == 1 and "Exchange SinglePartition" in text


def test_row_checks_read_the_rows_once(spark, good, plan, tmp_path):
    good.write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    checks = [
        *quality.STAGING_CHECKS,
        quality.Check("accepted_values", "grade", list("ABCDEFG")),
        quality.Check("accepted_values", "state", ["1", "2"]),
    ]
    assert plan(quality.run_checks(stored, checks)).count("FileScan parquet") == 2  # one is the uniqueness check's
    counts = failures(stored, checks)
    assert counts["accepted_values_grade"] == 1
    assert counts["accepted_values_state"] == stored.where("state not in ('1', '2')").select("state").distinct().count()


def test_no_rows(good):
    assert not any(failures(good.limit(0)).values())


def test_unknown_kind(good):
    with pytest.raises(ValueError):
        quality.Check("between", "grade").violated()


def test_watched_checks_equal_a_scan(spark, good, tmp_path):
    spoiled = good.union(good.limit(5)).withColumns({
        "grade": F.when(F.col("grade") != "B", F.col("grade")),
        "risk_tier": F.when(F.col("loan_amount") > 150_000, F.concat(F.lit("T"), F.col("state"))).otherwise(F.col("risk_tier")),
    })
    for n, rows in enumerate((spoiled, good, good.limit(0))):
        watched = quality.WatchedChecks()
        watched.watch(rows).write.parquet(f"{tmp_path}/{n}")
        report = watched.report(spark.read.schema(rows.schema).parquet(f"{tmp_path}/{n}"))
        assert {r["check_name"]: r["failures"] for r in report.collect()} == failures(rows)


def test_columns_are_tallied_by_themselves(spark, plan):
    """Many different values in two checked columns: no combinations of them."""
    df = spark.range(3000).selectExpr("concat('a', id % 50) AS a", "concat('b', id % 47) AS b", "if(id % 7 = 0, null, id) AS c")
    checks = [quality.Check("accepted_values", "a", ["a1"]), quality.Check("accepted_values", "b", ["b1"]), quality.Check("not_null", "c")]
    assert failures(df, checks) == {"accepted_values_a": 49, "accepted_values_b": 46, "not_null_c": 429}
    assert quality._row_checks(df, checks)._jdf.queryExecution().executedPlan().toString().count("keys=[_entry") == 2

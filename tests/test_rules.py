"""Column rules on edge values."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradewise import functions as rules
from gradewise.schemas import RISK_TIERS


def apply(spark, rule, values, type_="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()]


def test_percent(spark):
    values = ["10.65%", "10.65", " 7% ", "", "n/a", "%", None]
    assert apply(spark, rules.percent_to_double, values) == [10.65, 10.65, 7.0, None, None, None, None]
    assert apply(spark, rules.percent_to_double, [10.65, None], "double") == [10.65, None]


def test_default_flag(spark):
    values = ["Charged Off", "charged off", "DEFAULT", "Does not meet the credit policy. Status:Charged Off",
              "Does not meet the credit policy. Status:Fully Paid", "Fully Paid", "", None]
    assert apply(spark, rules.default_flag, values) == [True, True, True, True, False, False, False, False]
    exact = apply(spark, lambda c: rules.default_flag(c, case_sensitive=True), values)
    assert exact == [True, False, False, True, False, False, False, False]


def test_risk_tier(spark):
    values = [*"ABCDEFGH", "a", "", None]
    low, medium, high = "Low Risk", "Medium Risk", "High Risk"
    expected = [low, low, medium, medium, high, high, high, *["Unknown"] * 4]
    assert apply(spark, rules.risk_tier, values) == expected
    assert list(RISK_TIERS) == [low, medium, high]


@pytest.mark.parametrize("type_, values, expected", [
    ("bigint", [None, 0, -1, 1, 30, 31, 60, 61, 90, 91], [1, 1, 2, 2, 2, 3, 3, 4, 4, 5]),
    ("double", [0.0, -0.0, 0.5, 30.5, math.nan, math.inf, -math.inf], [1, 1, 2, 3, 5, 5, 2]),
    ("string", ["0", "30", "30.0", "abc", "", "91"], [1, 2, 2, 1, 1, 5]),
])
def test_dpd_bucket(spark, type_, values, expected):
    buckets = apply(spark, rules.dpd_bucket, values, type_)
    assert [int(b[0]) for b in buckets] == expected


def test_bucket_label(spark):
    labels = apply(spark, lambda c: rules.bucket_label(rules.dpd_bucket(c)), [0, 5, 45, 75, 100], "int")
    assert labels == ["Current", "DPD 1-30", "DPD 31-60", "DPD 61-90", "DPD 90+"]


def test_issue_month(spark):
    values = ["Dec-2011", "Dec-11", "dec-11", "Apr-97", "Apr-00", "Jan-69", "Jan-68", "Feb-1968", "Foo-11",
              "2011-12", "", None]
    expected = [dt.date(2011, 12, 1)] * 3 + [
        dt.date(1997, 4, 1), dt.date(2000, 4, 1), dt.date(1969, 1, 1), dt.date(2068, 1, 1), dt.date(1968, 2, 1),
        None, None, None, None,
    ]
    assert apply(spark, rules.parse_issue_month, values) == expected


def test_row_hash(spark):
    expected = hashlib.md5(b"1077501").hexdigest()
    assert apply(spark, rules.row_hash, ["1077501", None]) == [expected, None]
    assert apply(spark, rules.row_hash, [1077501], "bigint") == [expected]


def test_repayment_rate(spark):
    df = spark.createDataFrame([(50.0, 75.0), (1.0, 0.0), (1.0, None), (None, 5.0)], "p double, f double")
    got = [r[0] for r in df.select(rules.repayment_rate_pct(F.col("p"), F.col("f"))).collect()]
    assert got == [66.67, None, None, None]


def test_delinquency_predicates(spark):
    df = spark.createDataFrame(
        [("Default", None), ("default", None), ("Current", 1), ("Current", 0), (None, None), (None, -3)],
        "s string, m int",
    )
    wanted, signal = rules.is_delinquent_event(F.col("s"), F.col("m")), rules.has_delinquency(F.col("m"))
    assert [tuple(r) for r in df.where(wanted).collect()] == [("Default", None), ("Current", 1)]
    assert [r[0] for r in df.select(signal).collect()] == [False, False, True, False, False, False]


def test_month_and_grade(spark):
    assert apply(spark, rules.grade_or_unknown, ["A", None]) == ["A", "Unknown"]
    months = apply(spark, lambda c: rules.month_of(c).cast("date"), ["2011-12-31 23:59:59", None])
    assert months == [dt.date(2011, 12, 1), None]


def test_round_stable(spark):
    values = [1.005, 2.675, -1.005, 0.1 + 0.2, 1e25, math.inf, None]
    got = apply(spark, lambda c: rules.round_stable(c, 2), values, "double")
    assert got == [1.01, 2.68, -1.01, 0.3, 1e25, math.inf, None]
    assert math.isnan(apply(spark, lambda c: rules.round_stable(c, 2), [math.nan], "double")[0])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 10**7), min_size=1, max_size=50), st.randoms())
def test_rounded_sum_ignores_order(spark, cents, random):
    shuffled = cents[:]
    random.shuffle(shuffled)
    sums = [
        spark.createDataFrame([(c / 100,) for c in order], "v double").coalesce(1)
        .agg(rules.round_stable(F.sum("v"), 2)).first()[0]
        for order in (cents, shuffled)
    ]
    assert sums[0] == sums[1] == round(sum(cents) / 100, 2)

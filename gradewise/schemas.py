"""Schemas and value sets.

Everything in this module is a fixed value of the data model: the names, labels,
statuses and limits have to be spelled exactly like this for results to agree.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: business rules -------------------------------------------------

DEFAULTED_STATUSES = [
    "Charged Off",
    "Default",
    "Does not meet the credit policy. Status:Charged Off",
]

RISK_TIERS = {
    "Low Risk": ["A", "B"],
    "Medium Risk": ["C", "D"],
    "High Risk": ["E", "F", "G"],
}
UNKNOWN = "Unknown"

# Months since the last delinquency, sorted into buckets. The labels say "days past due"
# but the input counts months; thresholds and labels are kept as they are.
DPD_CURRENT = "1_Current"
DPD_UP_TO = [(30, "2_DPD 1-30"), (60, "3_DPD 31-60"), (90, "4_DPD 61-90")]
DPD_BEYOND = "5_DPD 90+"

# Text that a data-frame CSV reader takes for a missing value.
CSV_NULLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: layouts --------------------------------------------------------

SOURCE_COLUMNS = [
    "id", "loan_amnt", "funded_amnt", "grade", "sub_grade", "int_rate", "loan_status",
    "issue_d", "purpose", "addr_state", "mths_since_last_delinq", "total_pymnt",
    "out_prncp", "delinq_2yrs", "annual_inc", "dti",
]

RAW_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("loan_amnt", T.DoubleType()),
    T.StructField("funded_amnt", T.DoubleType()),
    T.StructField("grade", T.StringType()),
    T.StructField("sub_grade", T.StringType()),
    T.StructField("int_rate", T.DoubleType()),
    T.StructField("loan_status", T.StringType()),
    T.StructField("issue_date", T.DateType()),
    T.StructField("purpose", T.StringType()),
    T.StructField("addr_state", T.StringType()),
    T.StructField("mths_since_last_delinq", T.LongType()),
    T.StructField("total_pymnt", T.DoubleType()),
    T.StructField("out_prncp", T.DoubleType()),
    T.StructField("delinq_2yrs", T.LongType()),
    T.StructField("annual_inc", T.DoubleType()),
    T.StructField("dti", T.DoubleType()),
    T.StructField("ingest_ts", T.TimestampType()),
    T.StructField("row_hash", T.StringType()),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("loan_id", T.StringType()),
    T.StructField("grade", T.StringType()),
    T.StructField("loan_amount", T.DoubleType()),
    T.StructField("interest_rate", T.DoubleType()),
    T.StructField("loan_status", T.StringType()),
    T.StructField("issue_date", T.StringType()),
    T.StructField("mths_since_last_delinq", T.IntegerType()),
    T.StructField("total_payment", T.DoubleType()),
    T.StructField("outstanding_principal", T.DoubleType()),
    T.StructField("risk_tier", T.StringType()),
])

LAYERS = ["raw", "staging", "core", "mart"]

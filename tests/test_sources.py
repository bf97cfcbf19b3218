"""Files, raw-table layout, tables and event JSON."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from gradewise.plans.models import stg_loans
from gradewise.session import scratch_path, stream_session
from gradewise.sources import events, files, kafka, tables


def test_csv_text_and_missing_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'id,purpose,grade,desc\n1,"car, used",A,"two\nlines and ""quotes"""\n2,NA,n/a,\n03,None,B,x\n'
    )
    got = [tuple(r) for r in files.read_loans_csv(spark, str(tmp_path / "a.csv")).collect()]
    assert got == [
        ("1", "car, used", "A", 'two\nlines and "quotes"'), ("2", None, None, None), ("03", None, "B", "x"),
    ]


def test_csv_one_line_per_record(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,grade\n1,"A"\n2,\n')
    got = files.read_loans_csv(spark, str(tmp_path / "a.csv"), one_line_per_record=True).collect()
    assert [tuple(r) for r in got] == [("1", "A"), ("2", None)]


def test_csv_files_with_other_headers_stop_the_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,grade\n1,A\n")
    (tmp_path / "b.csv").write_text("grade,id\nA,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_loans_csv(spark, str(tmp_path)).collect()


def test_raw_layout_and_pruning(spark, raw, tmp_path, plan):
    path = str(tmp_path / "raw")
    files.write_raw(raw, path)
    folders = [d for d in os.listdir(path) if d.startswith("issue_month=")]
    assert "issue_month=__HIVE_DEFAULT_PARTITION__" in folders
    assert "issue_month=1997-04" in folders
    back = files.read_raw(spark, path)
    assert back.columns == raw.columns
    assert back.exceptAll(raw).isEmpty() and raw.exceptAll(back).isEmpty()

    april = files.read_raw(spark, path, dt.date(1997, 4, 1), dt.date(1997, 4, 30))
    assert april.count() == raw.where("issue_date = date '1997-04-01'").count() > 0
    text = plan(april)
    partition_filters = text.split("PartitionFilters: ")[1].split("]")[0]
    assert "issue_month" in partition_filters
    pushed = plan(april.where("grade = 'A'"))
    assert "EqualTo(grade,A)" in pushed


def test_raw_files_are_sorted_inside(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    files.write_raw(raw, path)
    one = spark.read.parquet(f"{path}/issue_month=1997-04").coalesce(1)
    keys = [(r[0] or "", r[1] or "") for r in one.select("grade", "loan_status").collect()]
    assert keys == sorted(keys)


def test_raw_write_brings_months_together(raw, tmp_path):
    """Many tasks do not each write a file into every month."""
    path = str(tmp_path / "raw")
    files.write_raw(raw.repartition(16), path)
    for folder in os.listdir(path):
        if folder.startswith("issue_month="):
            assert len([f for f in os.listdir(f"{path}/{folder}") if f.endswith(".parquet")]) <= 2


def test_month_too_large_for_one_task_is_split(spark, raw, tmp_path):
    """Loans without a date all share one partition folder, but not one task."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    undated = raw.withColumn("issue_date", F.lit(None).cast("date")).repartition(8)
    before = spark.conf.get(key)
    spark.conf.set(key, "32KB")
    try:
        files.write_raw(undated, str(tmp_path / "raw"))
    finally:
        spark.conf.set(key, before)
    folder = tmp_path / "raw" / "issue_month=__HIVE_DEFAULT_PARTITION__"
    assert len(list(folder.glob("*.parquet"))) > 1
    assert files.read_raw(spark, str(tmp_path / "raw")).count() == raw.count()


def test_tables(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    files.write_raw(raw, path)
    tables.create_layers(spark, str(tmp_path / "layers"))
    external = tables.external_table(spark, path, "raw.loans_raw")
    assert external.count() == raw.count()
    assert tables.source(spark, "raw", "loans_raw").count() == raw.count()
    assert tables.external_table(spark, path, "raw.loans_raw").count() == raw.count()
    view = tables.materialize(stg_loans(external), "some_view", "view")
    table = tables.materialize(view, "some_table", "table", layer="core")
    assert table.count() == view.count() == spark.table("core.some_table").count()
    tables.materialize(view.limit(3), "some_table", "table", layer="core")
    assert spark.table("core.some_table").count() == 3
    assert tables.external_view(spark, path, "raw_view").count() == raw.count()
    with pytest.raises(ValueError):
        tables.materialize(view, "x", "index")
    with pytest.raises(ValueError, match="session"):
        tables.materialize(view, "x", "view", layer="staging")
    # Declaring a table over files never deletes a managed table's own.
    with pytest.raises(ValueError, match="MANAGED"):
        tables.external_table(spark, path, "core.some_table")
    assert spark.table("core.some_table").count() == 3


MESSAGES = [
    (1, '{"loan_id": "1", "grade": "A", "loan_amount": 10.5, "mths_since_last_delinq": 3}'),
    (2, '{"loan_id": "2", "unknown": [1, 2]}'),
    (3, '{"loan_id": "3", "loan_amount": "lots", "grade": "B"}'),
    (4, "not json"),
    (5, "{}"),
    (6, None),
    (7, "[1]"),
    (8, ""),
    (9, '{"loan_id": "9", "grade": "C"'),
]


def test_parse_keeps_good_fields_and_drops_broken_records(spark):
    messages = spark.createDataFrame(MESSAGES, "n int, value string")
    parsed = {r["n"]: r for r in events.parse_events(messages, keep=("n",)).collect()}
    rejected = {r["n"]: r["value"] for r in events.reject_events(messages).collect()}
    assert parsed[1]["loan_amount"] == 10.5 and parsed[1]["mths_since_last_delinq"] == 3
    assert parsed[2]["loan_id"] == "2" and parsed[2]["grade"] is None
    assert parsed[3]["loan_amount"] is None and parsed[3]["grade"] == "B"
    assert parsed[5]["loan_id"] is None
    assert {4, 6, 7, 8} <= set(rejected) and rejected[4] == "not json"
    assert set(parsed) | set(rejected) == set(range(1, 10)) and not set(parsed) & set(rejected)


def test_published_json(spark, raw):
    staged = stg_loans(raw)
    one = events.to_events(staged.where("loan_id = '3'")).first()
    body = json.loads(one["value"])
    assert one["key"] == body["loan_id"] == "3"
    assert list(body) == [f.name for f in events.EVENT_SCHEMA]
    assert isinstance(body["issue_date"], str) and body["mths_since_last_delinq"] == 0
    no_grade = json.loads(events.to_events(staged.where("grade is null")).first()["value"])
    assert no_grade["grade"] is None  # written out, not left out


def test_publish_limit_repeats(raw):
    staged = stg_loans(raw)
    first, again = (
        [r["key"] for r in events.to_events(staged.repartition(n), limit=20).collect()] for n in (1, 5)
    )
    assert len(first) == 20 and sorted(first) == sorted(again)


def test_kafka_options():
    assert kafka.kafka_options("h:1", "loans", max_offsets=500) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "loans", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "500",
    }


def test_scratch_is_under_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(f"{root}/gradewise/x-") and one != two


def test_stream_settings_stay_in_their_session(spark):
    key = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    sibling = stream_session(spark, state_partitions=3)
    assert sibling.conf.get(key) == "true" and spark.conf.get(key) == "false"
    assert sibling.conf.get("spark.sql.shuffle.partitions") == "3"
    assert sibling.conf.get("spark.sql.session.timeZone") == "UTC"


def test_save_results(spark, tmp_path):
    results = {"a": spark.range(3), "b": spark.range(5)}
    paths = files.save_results(results, str(tmp_path), names=["b"])
    assert list(paths) == ["b"] and files.read_parquet(spark, paths["b"]).count() == 5
    files.save_results({"b": spark.range(2).select(F.col("id"))}, str(tmp_path))
    assert files.read_parquet(spark, paths["b"]).count() == 2

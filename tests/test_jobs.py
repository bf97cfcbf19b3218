"""Ingestion and the model build, end to end."""

from __future__ import annotations

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from gradewise.operators.quality import QualityError, run_checks
from gradewise.plans import ingest as ing
from gradewise.plans import refresh
from gradewise.plans.models import build_models, fct_loans, mart_loan_risk, stg_loans
from gradewise.schemas import RAW_SCHEMA, SOURCE_COLUMNS
from gradewise.sources import tables
from gradewise.sources.files import write_raw

HEADER = ",".join(SOURCE_COLUMNS) + ",unused"
LINES = [
    "1,1000,900,A,A1,10.65%,Fully Paid,Dec-2011,car,AZ,,500.5,0,0,24000,27.65,x",
    "2,2500,2500,C,C4,15.27,Charged Off,Dec-11,car,GA,35.0,1000,0,1,30000,1,x",
    ",9,9,A,A1,1%,Current,Dec-11,car,GA,1,1,1,1,1,1,x",
    "0004,abc,,NA,,n/a,,junk,None,,many,,,2.6,,NaN,x",
]


def write(path, lines, header=HEADER):
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_ingest_types_and_nulls(spark, tmp_path):
    raw = ing.ingest(spark, write(tmp_path / "a.csv", LINES), str(tmp_path / "raw"),
                     ingest_ts=F.lit("2024-01-02 03:04:05"))
    assert [(f.name, f.dataType) for f in raw.schema] == [(f.name, f.dataType) for f in RAW_SCHEMA]
    rows = {r["id"]: r.asDict() for r in raw.collect()}
    assert set(rows) == {"1", "2", "0004"}
    assert rows["1"]["int_rate"] == 10.65 and rows["1"]["issue_date"] == dt.date(2011, 12, 1)
    assert rows["1"]["mths_since_last_delinq"] is None and rows["1"]["loan_amnt"] == 1000.0
    assert rows["2"]["mths_since_last_delinq"] == 35 and rows["2"]["issue_date"] == dt.date(2011, 12, 1)
    assert rows["2"]["ingest_ts"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    bad = rows["0004"]
    assert bad["delinq_2yrs"] == 3  # 2.6, rounded
    for column in ("loan_amnt", "grade", "int_rate", "issue_date", "purpose", "mths_since_last_delinq", "dti"):
        assert bad[column] is None, column


def test_missing_columns_become_null(spark, tmp_path):
    path = write(tmp_path / "a.csv", ["1,A,B"], header="id,grade,else")
    raw = ing.ingest(spark, path, str(tmp_path / "raw"))
    row = raw.first()
    assert (row["id"], row["grade"], row["loan_amnt"], row["issue_date"]) == ("1", "A", None, None)
    assert row["ingest_ts"] is not None


def test_input_without_id_stops(spark, tmp_path):
    with pytest.raises(ValueError, match="id"):
        ing.ingest(spark, write(tmp_path / "a.csv", ["1,A"], header="ID_,grade"), str(tmp_path / "raw"))


@pytest.mark.parametrize("one_line", [False, True])
def test_surplus_fields_stop_or_are_put_aside(spark, tmp_path, one_line):
    lines = ["1,A,10", "2,B,20,EXTRA", "3,C", "4,\"D, E\",40", "5,F,50,", '6,"G",60,"x, y"']
    path = write(tmp_path / "a.csv", lines, header="id,grade,loan_amnt")
    with pytest.raises(Exception, match="more fields"):
        ing.ingest(spark, path, str(tmp_path / "stopped"), one_line_per_record=one_line)
    raw = ing.ingest(
        spark, path, str(tmp_path / "raw"), one_line_per_record=one_line, rejects_path=str(tmp_path / "rejects"),
    )
    assert sorted(tuple(r) for r in raw.select("id", "grade", "loan_amnt").collect()) == [
        ("1", "A", 10.0), ("3", "C", None), ("4", "D, E", 40.0), ("5", "F", 50.0),
    ]
    aside = sorted(r.value.strip() for r in spark.read.text(str(tmp_path / "rejects")).collect())
    assert aside == [lines[1], lines[5]]


def scratch_left(spark):
    folder = os.path.join(spark.conf.get("spark.checkpoint.dir"), "gradewise")
    return {x for x in os.listdir(folder) if x.startswith(("staged-loans", "new-keys"))} if os.path.exists(folder) else set()


def test_jobs_leave_no_scratch(spark, tmp_path):
    ing.ingest(spark, write(tmp_path / "a.csv", LINES), str(tmp_path / "raw"))
    ing.ingest(spark, write(tmp_path / "a.csv", LINES), str(tmp_path / "raw"))
    with pytest.raises(Exception, match="more fields"):
        ing.ingest(spark, write(tmp_path / "b.csv", [LINES[0] + ",surplus"]), str(tmp_path / "raw"))
    assert not scratch_left(spark)


def test_a_load_that_died_is_repaired(spark, tmp_path, monkeypatch):
    """Rows that a dead load has written are found again, though their keys are not in the side table."""
    raw_path = str(tmp_path / "raw")
    ing.ingest(spark, write(tmp_path / "a.csv", LINES[:1]), raw_path)
    with monkeypatch.context() as broken:
        broken.setattr(ing.keys, "add_keys", lambda *a: (_ for _ in ()).throw(OSError("disk")))
        with pytest.raises(OSError):
            ing.ingest(spark, write(tmp_path / "b.csv", LINES), raw_path)
    assert ing.read_raw(spark, raw_path).count() == 3
    assert ing.ingest(spark, write(tmp_path / "b.csv", LINES), raw_path).count() == 3
    assert ing.ingest(spark, write(tmp_path / "c.csv", [LINES[0].replace("1,1000", "9,1000")]), raw_path).count() == 4


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_files_are_taken_up_once(spark, tmp_path, files_per_batch):
    folder, raw, ledger = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "ledger")
    folder.mkdir()
    load = lambda: ing.ingest_new_files(
        spark, str(folder), raw, ledger, rejects_path=str(tmp_path / "rejects"), files_per_batch=files_per_batch,
    )
    assert load() == []
    write(folder / "a.csv", LINES)
    write(folder / "b.csv", [LINES[0].replace("1,1000", "7,1000"), LINES[0] + ",surplus"])
    assert sum(load()) == 6
    assert load() == []
    write(folder / "c.csv", [LINES[0], LINES[0].replace("1,1000", "8,1000")])
    os.utime(folder / "c.csv", (10**9, 10**9))  # decades older than the others
    assert load() == [2]
    got = ing.read_raw(spark, raw)
    assert sorted(r["id"] for r in got.collect()) == ["0004", "1", "2", "7", "8"]
    assert [r.value.strip() for r in spark.read.text(f"{tmp_path}/rejects/*").collect()] == [LINES[0] + ",surplus"]


def test_files_with_too_many_fields_stop_the_run(spark, tmp_path):
    folder, raw, ledger = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "ledger")
    folder.mkdir()
    write(folder / "a.csv", [LINES[0] + ",surplus"])
    with pytest.raises(Exception, match="more fields"):
        ing.ingest_new_files(spark, str(folder), raw, ledger)
    # The file isn't taken up yet.
    write(folder / "a.csv", LINES[:1])
    assert sum(ing.ingest_new_files(spark, str(folder), raw, ledger)) == 1
    assert ing.read_raw(spark, raw).count() == 1


def test_months_of_a_load_are_declared(spark, tmp_path):
    raw = str(tmp_path / "raw")
    ing.ingest(spark, write(tmp_path / "a.csv", LINES[:1]), raw)
    tables.external_table(spark, raw, "loans_by_month")
    later = [LINES[1], LINES[1].replace("2,2500", "3,1").replace("Dec-11", "Jan-2012"), LINES[3]]
    ing.ingest(spark, write(tmp_path / "b.csv", later), raw, table="loans_by_month")
    found = {r["issue_month"]: r["count"] for r in spark.table("loans_by_month").groupBy("issue_month").count().collect()}
    assert found == {"2011-12": 2, "2012-01": 1, None: 1}
    # A month that no load told of is not looked for.
    os.makedirs(f"{raw}/issue_month=1999-01")
    tables.add_months(spark, "loans_by_month", ["2012-01", "2012-01"])
    tables.add_months(spark, "loans_by_month", [])
    assert not [r for r in spark.sql("SHOW PARTITIONS loans_by_month").collect() if "1999" in r[0]]
    spark.sql("DROP TABLE loans_by_month")


def test_refresh_rebuilds_changed_months_only(spark, raw, tmp_path):
    for layer in ("raw", "core", "mart"):
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")
    tables.create_layers(spark, str(tmp_path / "layers"))
    clean = raw.where("grade is not null and loan_status is not null")
    path = str(tmp_path / "raw")
    first = (F.col("issue_date") < "2000-01-01") | F.col("issue_date").isNull()
    ing.merge_into_raw(spark, clean.where(first), path)
    tables.register_raw(spark, path)
    built = refresh.refresh_models(spark)
    assert len(built["months"]) > 12 and built["report"].count() == 5
    folder = tables.location(spark, refresh.FACTS).removeprefix("file:")
    files = lambda: {m: sorted(os.listdir(f"{folder}/{m}")) for m in os.listdir(folder) if m.startswith("issue_month")}
    before = files()
    assert refresh.refresh_models(spark)["months"] == []
    late = clean.where("issue_date >= '2000-06-01' and issue_date < '2000-08-01'").unionByName(
        clean.where("issue_date = '1999-05-01'").withColumns({"id": F.concat("id", F.lit("x")), "row_hash": F.md5(F.concat("id", F.lit("x")))})
    )
    ing.merge_into_raw(spark, late, path, table="raw.loans_raw")
    built = refresh.refresh_models(spark)
    assert built["months"] == ["1999-05", "2000-06", "2000-07"]
    after = files()
    assert {m for m in before if before[m] != after[m]} == {"issue_month=1999-05"} and len(after) == len(before) + 2
    whole = mart_loan_risk(fct_loans(stg_loans(tables.source(spark, "raw", "loans_raw")))).drop("total_loan_volume")
    mart = built["mart_loan_risk"].drop("total_loan_volume")
    assert mart.exceptAll(whole).isEmpty() and whole.exceptAll(mart).isEmpty()
    ing.merge_into_raw(spark, raw.where("grade is null"), path, table="raw.loans_raw")
    with pytest.raises(QualityError, match="not_null_grade"):
        refresh.refresh_models(spark)


def test_rerun_adds_nothing_and_changed_rows_stay(spark, tmp_path):
    raw_path = str(tmp_path / "raw")
    first = ing.ingest(spark, write(tmp_path / "a.csv", LINES), raw_path)
    before = {r["id"]: (r["loan_amnt"], r["ingest_ts"]) for r in first.collect()}
    assert ing.ingest(spark, write(tmp_path / "a.csv", LINES), raw_path).count() == 3
    changed = [LINES[0].replace("1,1000", "1,7777"), LINES[1].replace("2,2500", "5,2500")]
    after = {r["id"]: (r["loan_amnt"], r["ingest_ts"])
             for r in ing.ingest(spark, write(tmp_path / "b.csv", changed), raw_path).collect()}
    assert set(after) == {"1", "2", "0004", "5"}
    assert {k: after[k] for k in before} == before


@pytest.mark.parametrize("dedupe, expected", [(False, 4), (True, 3)])
def test_copies_inside_a_batch(spark, tmp_path, dedupe, expected):
    path = write(tmp_path / "a.csv", [*LINES, LINES[0]])
    raw = ing.ingest(spark, path, str(tmp_path / "raw"), dedupe_batch=dedupe)
    assert raw.count() == expected


def test_integer_columns_keep_their_values(spark):
    df = spark.createDataFrame([(2**60 + 1, 2**60 + 1, "5")], "id bigint, mths_since_last_delinq bigint, delinq_2yrs string")
    columns = [c if c != "issue_d" else "issue_date" for c in SOURCE_COLUMNS]
    row = ing.to_raw_schema(ing.pick_columns(df, columns)).first()
    assert (row["id"], row["mths_since_last_delinq"], row["delinq_2yrs"]) == (str(2**60 + 1), 2**60 + 1, 5)


def test_staging_and_facts(raw):
    staged = stg_loans(raw)
    assert staged.where("loan_id is null").isEmpty()
    assert staged.where("mths_since_last_delinq is null or delinq_2yrs is null").isEmpty()
    assert len(staged.columns) == 19
    facts = fct_loans(staged)
    assert len(facts.columns) == 21
    assert facts.where("is_defaulted is null").isEmpty()
    assert facts.where("repayment_rate_pct is null and funded_amount != 0").isEmpty()


def test_models_by_name(spark, raw, tmp_path):
    """Raw table, staged view and models in the catalog, where another session finds them."""
    tables.create_layers(spark, str(tmp_path / "layers"))
    path = str(tmp_path / "it's raw")
    write_raw(raw.where("grade is not null and loan_status is not null"), path)
    tables.register_raw(spark, path)
    build_models(spark)
    other = spark.newSession()
    staged = other.table("staging.stg_loans")
    want = stg_loans(tables.source(spark, "raw", "loans_raw"))
    assert staged.schema.names == want.schema.names
    assert staged.exceptAll(want).isEmpty() and want.exceptAll(staged).isEmpty() and not want.isEmpty()
    assert other.table("mart.mart_loan_risk").agg(F.sum("total_loans")).first()[0] == want.count()


def test_build_models(spark, raw, tmp_path):
    tables.create_layers(spark, str(tmp_path / "layers"))
    clean = raw.where("grade is not null and loan_status is not null")
    built = build_models(spark, clean)
    assert built["fct_loans"].count() == clean.count()
    assert spark.table("mart.mart_loan_risk").agg(F.sum("total_loans")).first()[0] == clean.count()
    assert build_models(spark, clean)["mart_loan_risk"].count() == 8  # replaces
    with pytest.raises(QualityError, match="not_null_grade"):
        build_models(spark, raw)
    want = {r["check_name"]: r["failures"] for r in run_checks(stg_loans(raw)).collect()}
    assert {r["check_name"]: r["failures"] for r in build_models(spark, raw, check="report")["report"].collect()} == want
    assert "report" not in build_models(spark, raw, check=False)
    none = build_models(spark, raw.limit(0), check="report")["report"]
    assert [r["failures"] for r in none.collect()] == [0] * 5


def test_checks_need_no_second_scan_of_the_raw_loans(spark, raw, tmp_path, monkeypatch):
    """The raw files are gone once the facts are written, and the checks still tell."""
    tables.create_layers(spark, str(tmp_path / "layers"))
    path = str(tmp_path / "once")
    raw.write.parquet(path)
    written = tables.materialize

    def materialize(df, name, kind, layer=None):
        out = written(df, name, kind, layer)
        if name == "fct_loans":
            shutil.rmtree(path)
        return out

    monkeypatch.setattr(tables, "materialize", materialize)
    report = build_models(spark, spark.read.parquet(path), check="report")["report"]
    assert {r["check_name"]: r["failures"] for r in report.collect()}["not_null_grade"] == raw.where("grade is null").count() > 0

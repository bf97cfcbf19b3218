"""The command line, over files."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from gradewise.__main__ import main
from gradewise.plans.models import stg_loans
from gradewise.sources.events import parse_events
from gradewise.sources.files import read_raw
from gradewise.streaming import sinks, windows
from tests.test_jobs import LINES, write


def test_from_csv_to_counter(spark, tmp_path, capsys):
    csv, raw = write(tmp_path / "a.csv", LINES), str(tmp_path / "raw")
    main(["ingest", csv, raw])
    main(["ingest", csv, raw])
    assert capsys.readouterr().out.count("3 loans") == 2

    main(["report", raw, str(tmp_path / "report")])
    assert spark.read.parquet(str(tmp_path / "report" / "default_by_grade")).count() == 3

    topic = str(tmp_path / "topic")
    main(["publish", "--files", topic, raw, "--limit", "2"])
    sent = spark.read.json(topic)
    assert sorted(r["loan_id"] for r in sent.collect()) == ["0004", "1"]

    main(["publish", "--files", topic, raw])
    out = str(tmp_path / "counts")
    main(["count", "--files", topic, out, str(tmp_path / "c1"), "--available-now"])
    counts = {r["grade"]: tuple(r)[1:] for r in sinks.newest(spark, out).collect()}
    assert counts == {"A": (2, 0), "C": (1, 1), "Unknown": (2, 0)}
    assert stg_loans(read_raw(spark, raw)).count() == 3

    for job in ("windows", "sessions"):
        main([job, "--files", topic, str(tmp_path / job), str(tmp_path / f"{job}-c"), "--available-now"])
    found = sinks.latest(spark.read.parquet(str(tmp_path / "windows")), "window_start", "window_end", "grade")
    assert {r["grade"]: r["n"] for r in found.groupBy("grade").agg(F.sum("total_loans").alias("n")).collect()} == {"A": 2, "C": 1, None: 2}
    sessions = sinks.newest(spark, str(tmp_path / "sessions"))
    events = parse_events(spark.read.text(topic))
    assert sessions.agg(F.sum("events_in_session")).first()[0] == windows.delinquent_events(events).count() > 0


def test_new_files_and_reports(spark, tmp_path, capsys):
    folder, raw, ledger = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "ledger")
    folder.mkdir()
    write(folder / "a.csv", LINES)
    main(["ingest", str(folder), raw, "--new-files", ledger])
    write(folder / "b.csv", [LINES[0].replace("1,1000", "9,1000")])
    main(["ingest", str(folder), raw, "--new-files", ledger])
    assert "3 loans" in capsys.readouterr().out.replace("4 loans", "3 loans, then 4 loans")
    with pytest.raises(SystemExit):
        main(["ingest", str(folder), "another", raw, "--new-files", ledger])
    topic, out = str(tmp_path / "topic"), str(tmp_path / "counts")
    main(["publish", "--files", topic, raw])
    main(["count", "--files", topic, out, str(tmp_path / "c"), "--report-every", "2", "--available-now"])
    told = capsys.readouterr().out
    assert "processed 2, " in told and told.count("processed 4, ") == 2 and "by grade" in told


def test_a_topic_or_files_are_required():
    with pytest.raises(SystemExit):
        main(["publish", "raw"])


def test_models(spark, tmp_path, capsys):
    csv, raw = write(tmp_path / "a.csv", LINES[:2]), str(tmp_path / "raw")
    main(["ingest", csv, raw])
    main(["models", raw, "--layers", str(tmp_path / "layers")])
    assert "default_rate_pct" in capsys.readouterr().out

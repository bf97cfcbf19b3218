"""Jobs for the command line: `spark-submit ... -m gradewise <job>` or `python -m gradewise <job>`."""

from __future__ import annotations

import argparse
import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession

from gradewise.plans.ingest import ingest, ingest_new_files
from gradewise.plans.models import build_models, stg_loans
from gradewise.plans.report import run_report
from gradewise.session import build_session, stream_session
from gradewise.sources import tables
from gradewise.sources.events import parse_events, to_events
from gradewise.sources.files import read_raw
from gradewise.sources.kafka import kafka_events, send_to_kafka
from gradewise.streaming import counter, sinks, windows
from gradewise.streaming.runner import late_rows, start_query


def _ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    options = {
        "dedupe_batch": args.dedupe_batch, "one_line_per_record": args.one_line_per_record, "rejects_path": args.rejects, "table": args.table,
    }
    if args.new_files:
        if len(args.csv) != 1:
            raise SystemExit("--new-files takes one folder")
        ingest_new_files(spark, args.csv[0], args.raw, args.new_files, **options)
    else:
        ingest(spark, args.csv, args.raw, **options)
    print(f"{read_raw(spark, args.raw).count():,} loans in {args.raw}")


def _models(spark: SparkSession, args: argparse.Namespace) -> None:
    tables.create_layers(spark, args.layers)
    tables.register_raw(spark, os.path.abspath(args.raw) if "://" not in args.raw else args.raw)
    build_models(spark)["mart_loan_risk"].show()


def _report(spark: SparkSession, args: argparse.Namespace) -> None:
    for name, result in run_report(spark, args.loans, args.out, args.timestamp).items():
        print(name)
        result.show()


def _publish(spark: SparkSession, args: argparse.Namespace) -> None:
    events = to_events(stg_loans(read_raw(spark, args.raw)), args.limit)
    if args.servers:
        send_to_kafka(events, args.servers, args.topic, _pairs(args.option))
    else:
        events.select("value").write.mode("append").text(args.files)


def _events(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    streams = stream_session(spark)
    if args.servers:
        return kafka_events(streams, args.servers, args.topic, more=_pairs(args.option))
    return parse_events(streams.readStream.text(args.files))


def _pairs(given: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in given)


def _stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Windows that close by the clock are appended as they close. A run that is to end can't wait for the clock and
    its ticks never run out, so it gives open windows too: as updates, and sessions, which can't be updated, as a snapshot."""
    events = _events(spark, args)
    report_every = args.report_every if args.job == "count" else None
    if report_every:
        results, mode = events, "append"
    elif args.job == "count":
        results, mode = counter.delinquency_by_grade(events), "complete"
    else:
        clocked = windows.with_processing_time(events if args.available_now else windows.with_ticks(events))
        window = windows.tumbling_by_grade if args.job == "windows" else windows.delinquency_sessions
        results, mode = window(clocked), "append"
        if args.available_now:
            mode = "update" if args.job == "windows" else "complete"
    if report_every:
        sink = counter.reports_every(args.out, report_every)
    elif args.jdbc_url:
        column = None if args.declared_columns else "batch_id"
        sink = sinks.jdbc_batches(args.jdbc_url, args.table, _pairs(args.jdbc_property), column)
    else:
        sink = {"append": args.out, "update": sinks.parquet_batches(args.out), "complete": sinks.snapshot_batches(args.out)}[mode]
    query = start_query(results, sink, args.checkpoint, mode, args.interval, args.available_now, late_path=args.late)
    query.awaitTermination()
    if report_every:
        _told(counter.reports(spark, args.out).orderBy("total_loans").toLocalIterator())
        _told(counter.delinquency_totals(counter.totals(spark, args.out)).collect())
    if late := late_rows(query):
        print(f"{late:,} late rows were dropped")


def _told(rows: Iterable[Row]) -> None:
    for row in rows:
        print(f"processed {row['total_loans']:,}, delinquent {row['delinquent_loans']:,} ({row['delinquency_rate_pct']} %)")
        if "by_grade" in row:
            print(f"  by grade: {dict(sorted(row['by_grade'].items()))}")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gradewise", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("ingest", help="CSV files into the raw table, new ids only")
    job.add_argument("csv", nargs="+")
    job.add_argument("raw")
    job.add_argument("--dedupe-batch", action="store_true")
    job.add_argument("--rejects", help="folder for lines with too many fields, which else stop the load")
    job.add_argument("--new-files", metavar="CHECKPOINT", help="load the folder's files that no run with this checkpoint has loaded")
    job.add_argument("--table", help="catalog table over the raw folder, to which the load's months are declared")
    job.add_argument("--one-line-per-record", action="store_true", help="no field holds line breaks: split files")
    job.set_defaults(run=_ingest)

    job = jobs.add_parser("models", help="staging, fact and mart layers, then checks")
    job.add_argument("raw")
    job.add_argument("--layers", help="folder of the layer databases")
    job.set_defaults(run=_models)

    job = jobs.add_parser("report", help="the four portfolio reports")
    job.add_argument("loans")
    job.add_argument("out")
    job.add_argument("--timestamp", default="ingest_ts", help="column the months come from")
    job.set_defaults(run=_report)

    topic = argparse.ArgumentParser(add_help=False)
    place = topic.add_mutually_exclusive_group(required=True)
    place.add_argument("--servers", help="Kafka bootstrap servers")
    place.add_argument("--files", help="folder of JSON lines, in place of a topic")
    topic.add_argument("--topic", default="loan-events")
    topic.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="further Kafka options")

    job = jobs.add_parser("publish", parents=[topic], help="staged loans as events")
    job.add_argument("raw")
    job.add_argument("--limit", type=int, help="only the first loans by id")
    job.set_defaults(run=_publish)

    for name, text in {
        "windows": "five-minute windows by grade",
        "sessions": "delinquency sessions by grade",
        "count": "running count of delinquent loans by grade",
    }.items():
        job = jobs.add_parser(name, parents=[topic], help=text)
        job.add_argument("out", help="results folder")
        job.add_argument("checkpoint")
        job.add_argument("--jdbc-url", help="write to a database instead of the folder")
        job.add_argument("--table")
        job.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE", help="user, password, driver ...")
        job.add_argument("--declared-columns", action="store_true", help="the table has no batch_id column")
        job.add_argument("--interval", default="10 seconds")
        job.add_argument("--report-every", type=int, help="count: a report whenever so many more messages have come")
        job.add_argument("--late", help="folder for the number of rows that each batch dropped as too late")
        job.add_argument("--available-now", action="store_true", help="work off what is there and stop")
        job.set_defaults(run=_stream)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    args.run(build_session(f"gradewise-{args.job}"), args)


if __name__ == "__main__":
    main()

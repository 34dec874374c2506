"""Command line of the job, for spark-submit with `main.py`: publish, process, results, fold, tables."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from incident_stream.plans.pipelines import run
from incident_stream.schema import (
    ANOMALIES,
    DEFAULT_THRESHOLD,
    DEFAULT_WINDOW_DAYS,
    MONTHLY,
    WINDOWED,
)
from incident_stream.settings import (
    DELAYS,
    FileStore,
    JdbcStore,
    Params,
    RecordSource,
    database_properties,
    prepare_session,
)
from incident_stream.sources.publish import publish_lines, publish_new_files
from incident_stream.sources.results import read_results
from incident_stream.streaming.log import KEEP_SECONDS
from incident_stream.streaming.queries import await_all
from incident_stream.streaming.sinks import MODES, create_tables, fold

DEFAULT_TOPIC = "incident-records"
RESULTS = ("aggregates", "anomalies")


def _add_source(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--bootstrap-servers", help="Kafka servers")
    parser.add_argument("--input-topic", default=DEFAULT_TOPIC, help="topic of the record lines")
    parser.add_argument("--lines-dir", help="directory of text files, in place of Kafka")
    parser.add_argument(
        "--source-option",
        action="append",
        default=[],
        metavar="NAME=VALUE",
        help="option of the source, e.g. maxOffsetsPerTrigger=50000000",
    )


def _add_store(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--results-dir", help="folder for result tables as Parquet")
    parser.add_argument("--jdbc-url", help="database for result tables, in place of the folder")
    parser.add_argument("--connections", type=int, default=8, help="database connections")


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="incident_stream")
    commands = parser.add_subparsers(dest="command", required=True)

    publish = commands.add_parser("publish", help="publish CSV files, one message per line")
    publish.add_argument("--in-dir", required=True)
    publish.add_argument("--on-error", choices=["fail", "skip"], default="fail")
    publish.add_argument(
        "--manifest", help="folder that notes the files that were sent, to send none twice"
    )
    _add_source(publish)

    process = commands.add_parser("process", help="run the two streaming queries")
    _add_source(process)
    _add_store(process)
    process.add_argument("--static-file", required=True, help="CSV of the codes")
    process.add_argument("--checkpoint-location", required=True)
    process.add_argument("--delay", choices=DELAYS, required=True)
    process.add_argument("-D", "--window-days", type=int, default=DEFAULT_WINDOW_DAYS)
    process.add_argument("-P", "--threshold", type=float, default=DEFAULT_THRESHOLD)
    process.add_argument("--sink-mode", choices=MODES, default="upsert")
    process.add_argument("--state-partitions", type=int)
    process.add_argument(
        "--results",
        choices=RESULTS,
        nargs="+",
        default=list(RESULTS),
        help="which of the two to maintain, so that two jobs need not do one twice",
    )
    process.add_argument(
        "--unique-codes", action="store_true", help="refuse codes that stand more than once"
    )
    pace = process.add_mutually_exclusive_group()
    pace.add_argument("--available-now", action="store_true", help="end at the last record")
    pace.add_argument("--processing-time", metavar="INTERVAL", help="e.g. '1 minute'")

    results = commands.add_parser("results", help="write out both stored results in full")
    _add_store(results)
    results.add_argument("--delay", choices=DELAYS, default="A")
    results.add_argument(
        "--out-dir", required=True, help="folder for both tables, all rows, as CSV with header"
    )
    results.add_argument("--rows", type=int, help="also print so many rows of each, as a preview")

    folding = commands.add_parser("fold", help="merge the finished batches of logged tables")
    folding.add_argument("--results-dir", required=True)
    folding.add_argument(
        "--keep-seconds",
        type=float,
        default=KEEP_SECONDS,
        help="how long readers that began before may need what is folded",
    )
    folding.add_argument("--delay", choices=DELAYS, default="A")

    tables = commands.add_parser("tables", help="create the result tables in a database")
    tables.add_argument("--jdbc-url", required=True)
    return parser


def source_of(args: argparse.Namespace) -> RecordSource:
    options = dict(text.split("=", 1) for text in args.source_option)
    if args.lines_dir:
        return RecordSource.text(args.lines_dir, **options)
    if not args.bootstrap_servers:
        raise SystemExit("one of --bootstrap-servers and --lines-dir is required")
    return RecordSource.kafka(args.bootstrap_servers, args.input_topic, **options)


def store_of(args: argparse.Namespace) -> FileStore | JdbcStore:
    if args.jdbc_url:
        return JdbcStore(args.jdbc_url, database_properties(), args.connections)
    if not args.results_dir:
        raise SystemExit("one of --results-dir and --jdbc-url is required")
    return FileStore(args.results_dir)


def trigger_of(args: argparse.Namespace) -> dict | None:
    if args.available_now:
        return {"availableNow": True}
    return {"processingTime": args.processing_time} if args.processing_time else None


def main(argv: Sequence[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    spark = prepare_session(SparkSession.builder.appName("incident-stream").getOrCreate())
    if args.command == "publish":
        if args.manifest:
            publish_new_files(spark, args.in_dir, source_of(args), args.manifest, args.on_error)
        else:
            publish_lines(spark, args.in_dir, source_of(args), args.on_error)
    elif args.command == "process":
        queries = run(
            spark,
            source_of(args),
            args.static_file,
            store_of(args),
            args.checkpoint_location,
            Params(args.delay, args.window_days, args.threshold),
            args.sink_mode,
            trigger_of(args),
            results=tuple(args.results),
            state_partitions=args.state_partitions,
            unique_codes=args.unique_codes,
        )
        await_all(queries)
    elif args.command == "tables":
        store = JdbcStore(args.jdbc_url, database_properties())
        create_tables(spark, store, MONTHLY, WINDOWED, ANOMALIES)
    else:
        for contract in (MONTHLY if args.delay == "A" else WINDOWED, ANOMALIES):
            if args.command == "fold":
                fold(spark, FileStore(args.results_dir), contract, args.keep_seconds)
                continue
            found = read_results(spark, store_of(args), contract)
            found.write.csv(f"{args.out_dir.rstrip('/')}/{contract.table}", header=True)
            if args.rows:
                found.show(args.rows, truncate=False)

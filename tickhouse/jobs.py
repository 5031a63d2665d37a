"""``spark-submit`` entry points: ingest, status, costs, sample, compact (behind a quiet window)."""

from __future__ import annotations

import argparse
from datetime import date, datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tickhouse.operators.costs import cost_snapshot, flat_lines
from tickhouse.operators.upkeep import quiet_tables
from tickhouse.plans.compaction import CompactionRefused, compact_days, compact_iceberg
from tickhouse.plans.report import export_status
from tickhouse.session import DEFAULT_TARGET_FILE_BYTES, configure, target_file_bytes
from tickhouse.sources.frames import read_topic, stream_landed, topic_options
from tickhouse.sources.sinks import write_snapshot
from tickhouse.streaming.sampler import read_samples, sample_tables
from tickhouse.streaming.ingest import BatchWriter, IngestPaths, start_ingest


def instant(text: str) -> datetime:
    value = datetime.fromisoformat(text.replace("Z", "+00:00"))
    return value if value.tzinfo else value.replace(tzinfo=timezone.utc)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tickhouse")
    commands = top.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest", help="frames to stored bars")
    source = ingest.add_mutually_exclusive_group(required=True)
    source.add_argument("--landed", help="folder of landed frames")
    source.add_argument("--servers", help="brokers of the frame topic")
    ingest.add_argument("--topic", default="bars")
    ingest.add_argument("--root", required=True, help="folder of the raw table and its ledger")
    ingest.add_argument("--query-id", default="ingest")
    ingest.add_argument("--table", help="append to this catalog.namespace.table, not to --root/bars")
    ingest.add_argument("--max-per-trigger", type=int)
    ingest.add_argument("--min-per-trigger", type=int, help="topic: frames to wait for ...")
    ingest.add_argument("--max-delay", default="300s", help="... but no longer than this")
    ingest.add_argument("--backfill", action="store_true", help="gather rows by date before writing")
    ingest.add_argument("--interval", default="300 seconds")
    ingest.add_argument("--drain", action="store_true", help="stop when everything is read")
    ingest.add_argument("--strict", action="store_true", help="fail on a malformed frame")

    status = commands.add_parser("status", help="status documents from a saved log export")
    status.add_argument("--input", required=True)
    status.add_argument("--output", required=True)
    status.add_argument("--now", type=instant)
    status.add_argument("--table-metadata")
    status.add_argument("--cost-snapshot")
    status.add_argument("--json-lines", action="store_true", help="one log entry per line")
    status.add_argument("--forbid", action="append", default=[], help="further text that no document may contain")

    costs = commands.add_parser("costs", help="cost snapshot from a billing export")
    costs.add_argument("--billing", required=True)
    costs.add_argument("--project", required=True)
    costs.add_argument("--output", required=True)
    costs.add_argument("--now", type=instant)

    sample = commands.add_parser("sample", help="record the version of tables at an interval")
    sample.add_argument("--table", action="append", required=True, metavar="NAME=METADATA_FOLDER_OR_BAR_FOLDER")
    sample.add_argument("--kind", choices=("metadata", "folder"), default="metadata")
    sample.add_argument("--samples", required=True)
    sample.add_argument("--interval", type=int, default=60, help="seconds")
    sample.add_argument("--count", type=int, help="stop after so many samples; default never")

    compact = commands.add_parser("compact", help="guarded data-file compaction")
    where = compact.add_mutually_exclusive_group(required=True)
    where.add_argument("--root", help="bar folder that ingest fills")
    where.add_argument("--table", help="catalog.namespace.table of an Iceberg table")
    compact.add_argument("--target", help="new folder, with --root")
    compact.add_argument("--day", type=date.fromisoformat, action="append", help="with --root; default all")
    compact.add_argument("--expected", required=True, help="snapshot, or folder version with --root, when the run was planned")
    compact.add_argument("--samples", help="table samples (job sample); the table must have been quiet until now")
    compact.add_argument("--run-now", action="store_true", help="do without a quiet window")
    compact.add_argument("--now", type=instant)
    compact.add_argument("--quiet-seconds", type=int, default=900)
    compact.add_argument("--max-gap-seconds", type=int, default=120)
    compact.add_argument("--receipt", required=True)
    compact.add_argument("--run-id", required=True)
    compact.add_argument("--target-bytes", type=int, default=DEFAULT_TARGET_FILE_BYTES)
    return top


def run(spark: SparkSession, arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    configure(spark)
    now = getattr(args, "now", None) or datetime.now(timezone.utc)
    if args.command == "ingest":
        names = ("bars", "quarantine", "ledger", "checkpoint")
        paths = IngestPaths(**{name: f"{args.root}/{name}" for name in names})
        if args.landed:
            frames = stream_landed(spark, args.landed, max_files=args.max_per_trigger)
        else:
            frames = read_topic(spark, topic_options(
                args.servers, args.topic, args.max_per_trigger, args.min_per_trigger, args.max_delay))
        writer = BatchWriter(paths, args.query_id, args.strict, table=args.table, rebalance=args.backfill)
        start_ingest(frames, writer, args.drain, args.interval).awaitTermination()
    elif args.command == "status":
        export_status(spark, args.output, now, args.input, metadata_document=args.table_metadata,
                      cost_document=args.cost_snapshot, json_lines=args.json_lines,
                      forbidden=tuple(args.forbid))
    elif args.command == "costs":
        lines = flat_lines(spark.read.parquet(args.billing))
        write_snapshot(cost_snapshot(lines, F.lit(now), args.project), args.output)
    elif args.command == "sample":
        places = dict(pair.split("=", 1) for pair in args.table)
        sample_tables(spark, places, args.samples, args.kind, args.interval, args.count)
    else:
        size = target_file_bytes(args.target_bytes)
        name = args.root or args.table
        if not args.run_now:
            if not args.samples:
                raise ValueError("give --samples for the quiet window, or --run-now to do without")
            own = read_samples(spark, args.samples).filter(F.col("table_id") == name)
            quiet = quiet_tables(own, now, args.quiet_seconds, args.max_gap_seconds)
            if not quiet.filter("is_quiet").limit(1).count():
                raise CompactionRefused(["quiet_window"])
        if args.root:
            if not args.target:
                raise ValueError("--root needs --target")
            compact_days(spark, args.root, args.target, args.receipt, args.run_id, args.expected,
                         args.day, size)
        else:
            compact_iceberg(spark, args.table, args.expected, args.receipt, args.run_id, size)


if __name__ == "__main__":
    run(SparkSession.builder.appName("tickhouse").getOrCreate())

"""Command line of the jobs, for ``spark-submit`` or ``python -m tickflow``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Row, SparkSession

from tickflow.config import JobConfig, exchange_a, exchange_b
from tickflow.operators.markets import missing_quotes
from tickflow.plans.newest import newest_file, newest_window
from tickflow.plans.producers import polled_messages, pushed_messages, shared_names
from tickflow.plans.ticks import backfill
from tickflow.scratch import remove_folders
from tickflow.session import SEOUL, tick_session
from tickflow.sinks.messages import follow, publish_to_folder, publish_to_topic
from tickflow.sinks.published import compact_day
from tickflow.sources.payloads import read_markets, read_payloads, stream_payloads
from tickflow.sources.state import open_top
from tickflow.sources.ticks import (
    kafka_messages,
    kafka_options,
    landed_messages,
    stored_messages,
    topic_partitions,
)
from tickflow.jobs.gate import late_ticks, start_gate
from tickflow.jobs.job import run_available, start_job

EXCHANGES = {"a": exchange_a, "b": exchange_b}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tickflow", description=__doc__)
    parser.add_argument("--zone", default=SEOUL, help="zone of window bounds and days")
    parser.add_argument("--shuffle-partitions", type=int)
    commands = parser.add_subparsers(dest="command", required=True)

    def source(command: argparse.ArgumentParser) -> None:
        command.add_argument("--folder", help="landing folder of the messages")
        command.add_argument("--max-files", type=int, help="files per micro-batch")
        command.add_argument(
            "--from-latest", action="store_true", help="leave out files that are there at the first start"
        )
        command.add_argument("--servers", help="brokers, if messages come from a topic")
        command.add_argument("--topic")
        command.add_argument("--group")
        command.add_argument("--max-offsets", type=int, help="messages per micro-batch")
        command.add_argument("--min-partitions", type=int, help="tasks that read the topic")

    def apart(command: argparse.ArgumentParser) -> None:
        command.add_argument(
            "--partitions", type=int, help="follow all topic partitions, so many, with own watermarks"
        )

    def target(command: argparse.ArgumentParser) -> None:
        command.add_argument("--to-folder")
        command.add_argument("--to-servers")
        command.add_argument("--to-topic")

    def windows(command: argparse.ArgumentParser) -> None:
        command.add_argument("--exchange", choices=sorted(EXCHANGES), required=True)
        command.add_argument("--output", required=True)
        command.add_argument("--duration", default="1 minute")
        command.add_argument("--top", type=int, default=5)
        command.add_argument("--exact", action="store_true", help="sums that do not depend on the order of ticks")

    job = commands.add_parser("job", help="rank the markets of every closed window")
    source(job)
    apart(job)
    windows(job)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--delay", default="1 second")
    job.add_argument("--trigger", default="1 minute")
    job.add_argument("--once", action="store_true", help="work off what is there and stop")

    gate = commands.add_parser("gate", help="set ticks apart whose window is closed, before the job")
    source(gate)
    gate.add_argument("--exchange", choices=sorted(EXCHANGES), required=True)
    gate.add_argument("--duration", default="1 minute", help="that of the job")
    gate.add_argument("--delay", default="1 second", help="that of the job")
    gate.add_argument("--trigger", default="1 minute")
    gate.add_argument("--checkpoint", required=True)
    gate.add_argument("--gate", required=True, help="folder; the job reads its on-time folder")
    gate.add_argument("--once", action="store_true", help="work off what is there and stop")

    late = commands.add_parser("late", help="show the ticks that a gate has set apart")
    late.add_argument("--exchange", choices=sorted(EXCHANGES), required=True)
    late.add_argument("--gate", required=True)

    stored = commands.add_parser("backfill", help="the same for stored messages")
    stored.add_argument("--folder", required=True)
    windows(stored)
    stored.add_argument("--batch", required=True, help="name of this run; reuse it to redo it")

    polled = commands.add_parser("polled", help="messages from landed quote responses")
    polled.add_argument("--listing", required=True)
    polled.add_argument("--quotes", required=True)
    polled.add_argument("--checkpoint", help="keep following the quotes folder")
    target(polled)

    pushed = commands.add_parser("pushed", help="messages from pushed frames")
    source(pushed)
    pushed.add_argument("--listing", required=True)
    pushed.add_argument("--other-listing", required=True)
    pushed.add_argument("--checkpoint", required=True)
    target(pushed)

    newest = commands.add_parser("newest", help="show the newest published result")
    newest.add_argument("--output", required=True)
    newest.add_argument("--day", help="yyyy-MM-dd; default is today")
    newest.add_argument("--window", action="store_true", help="newest window, not newest file")

    open_ = commands.add_parser("open", help="show the ranking of windows that are still open")
    open_.add_argument("--exchange", choices=sorted(EXCHANGES), required=True)
    open_.add_argument("--checkpoint", required=True)
    open_.add_argument("--top", type=int, default=5)
    open_.add_argument("--exact", action="store_true", help="if the job has it")

    compact = commands.add_parser("compact", help="one file for a finished day")
    compact.add_argument("--output", required=True)
    compact.add_argument("--day", required=True, help="yyyy-MM-dd")
    return parser


def _print(rows: DataFrame) -> None:
    """All rows, tab-separated, without holding them all at once."""
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def _stream(
    spark: SparkSession, args: argparse.Namespace, partition: int | None = None
) -> DataFrame:
    if args.folder:
        first = args.checkpoint if args.from_latest else None
        return landed_messages(spark, args.folder, args.max_files, latest_for=first)
    options = kafka_options(
        args.servers,
        args.topic,
        args.group,
        max_offsets=args.max_offsets,
        min_partitions=args.min_partitions,
        partition=partition,
    )
    return kafka_messages(spark, options)


def _job(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.partitions and args.folder:
        raise SystemExit("--partitions is for topics: a folder would be read once for each")
    if args.partitions:
        there = topic_partitions(spark, args.servers, args.topic)
        if args.partitions != there:
            raise SystemExit(f"--partitions is {args.partitions}, but {args.topic} has {there}")
        messages = [_stream(spark, args, number) for number in range(args.partitions)]
    else:
        messages = _stream(spark, args)
    if args.once:
        run_available(messages, _config(args))
    else:
        start_job(messages, _config(args)).awaitTermination()


def _config(args: argparse.Namespace) -> JobConfig:
    names = ("zone", "duration", "exact", "top", "delay", "trigger", "shuffle_partitions")
    given = {name: getattr(args, name) for name in names if hasattr(args, name)}
    return EXCHANGES[args.exchange](getattr(args, "output", ""), getattr(args, "checkpoint", ""), **given)


def _send(messages: DataFrame, args: argparse.Namespace, batch: str | None = None) -> None:
    if args.to_folder:
        publish_to_folder(messages, args.to_folder, text="value", batch=batch)
    else:
        publish_to_topic(messages, args.to_servers, args.to_topic, text="value")


def _polled(spark: SparkSession, args: argparse.Namespace) -> None:
    def one_round(payloads: DataFrame, batch: str | None = None) -> None:
        # The newest listing counts from the next round on.
        markets = read_markets(payloads.sparkSession, args.listing).persist()
        try:
            messages = polled_messages(markets, payloads)
            _send(messages, args, batch)
            print("listed markets without a quote:")
            _print(missing_quotes(markets, messages))
        finally:
            markets.unpersist()
            remove_folders(spark)

    if args.checkpoint:
        follow(stream_payloads(spark, args.quotes), one_round, args.checkpoint).awaitTermination()
    else:
        one_round(read_payloads(spark, args.quotes))


def _pushed(spark: SparkSession, args: argparse.Namespace) -> None:
    def one_round(frames: DataFrame, batch: str) -> None:
        session = frames.sparkSession
        names = shared_names(
            read_markets(session, args.listing), read_markets(session, args.other_listing)
        )
        _send(pushed_messages(frames, names), args, batch)
        remove_folders(spark)

    follow(_stream(spark, args), one_round, args.checkpoint).awaitTermination()


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"tickflow-{args.command}")
    base = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate()
    spark = tick_session(base, args.zone, args.shuffle_partitions)
    if args.command == "job":
        _job(spark, args)
    elif args.command == "backfill":
        counts = backfill(stored_messages(spark, args.folder), _config(args), args.batch)
        print(", ".join(f"{name}: {n}" for name, n in counts.items()))
    elif args.command == "polled":
        _polled(spark, args)
    elif args.command == "pushed":
        _pushed(spark, args)
    elif args.command == "gate":
        once = {"availableNow": True} if args.once else None
        start_gate(_stream(spark, args), _config(args), args.gate, args.checkpoint, once).awaitTermination()
    elif args.command == "late":
        _print(late_ticks(spark, _config(args), args.gate))
    elif args.command == "open":
        _print(open_top(spark, _config(args)).orderBy("window_start", "row_num"))
    elif args.command == "compact":
        year, month, day = args.day.split("-")
        compact_day(spark, args.output, Row(year=year, month=month, day=day), f"day-{args.day}")
    else:
        day = tuple(args.day.split("-")) if args.day else None
        show = newest_window if args.window else newest_file
        _print(show(spark, args.output, day))
    remove_folders(spark)


if __name__ == "__main__":
    main()

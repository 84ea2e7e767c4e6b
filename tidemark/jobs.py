"""Run one of the three jobs from the command line.

    python -m tidemark.jobs word-count   --servers HOST:PORT --input lines --output counts
    python -m tidemark.jobs ticket-sales --servers HOST:PORT --input sales --output totals
    python -m tidemark.jobs rated-movies --servers HOST:PORT --input ratings --movies movies
                                         --movie-table /shared/movies --output rated

With ``--files`` in place of ``--servers`` the names are folders: text files, one
message a line, in; Parquet out.  Start it with ``spark-submit`` on a cluster.
"""

from __future__ import annotations

import argparse
import signal
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark import session
from tidemark.plans import rated_movies, ticket_sales, word_count
from tidemark.sources import readers
from tidemark.streaming import sinks


def _arguments(given: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemark.jobs", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("word-count", "ticket-sales", "rated-movies"):
        job = jobs.add_parser(name)
        where = job.add_mutually_exclusive_group(required=True)
        where.add_argument("--servers", help="Kafka bootstrap servers")
        where.add_argument("--files", action="store_true", help="read and write folders")
        job.add_argument("--input", required=True)
        job.add_argument("--output", required=True)
        job.add_argument("--start", choices=["latest", "earliest"], help="topics only; default: latest")
        job.add_argument("--since", type=datetime.fromisoformat, metavar="TIME",
                         help="leave out records of before, e.g. lines of older files")
        job.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                         help="passed to the Kafka source and sink, e.g. security settings")
        job.add_argument("--checkpoint", help="folder to go on from; default: a new one")
        job.add_argument("--reset", action="store_true", help="start over in a new folder; give a new output folder too")
        job.add_argument("--once", action="store_true", help="handle what is there and stop")
        job.add_argument("--every", default="10 seconds")
        job.add_argument("--partitions", type=int, help="state partitions, kept for a query's life")
        if name != "rated-movies":
            job.add_argument("--changes", action="store_true",
                             help="topics only: OUTPUT is a folder for a row per record, not changed totals")
        if name != "word-count":
            job.add_argument("--rejected", help="where messages go that do not decode")
        if name == "ticket-sales":
            job.add_argument("--minutes", help="where closed windows go; default: the console")
            job.add_argument("--exact-minutes", metavar="FOLDER",
                             help="topics only: closed windows and late sales by the record-order rule, in place of --minutes")
            job.add_argument("--sales-table", help="folder between the queries; default: a new one")
        if name == "rated-movies":
            job.add_argument("--movies", required=True)
            job.add_argument("--movie-table", required=True, help="folder between the two queries")
            job.add_argument("--salts", type=int, default=1, help="split ratings of one id and time")
    args = parser.parse_args(given)
    if args.files and args.start:
        parser.error("--start is for topics; use --since with --files")
    if args.files and getattr(args, "changes", False):
        parser.error("--changes needs the offsets of a topic")
    if args.files and getattr(args, "exact_minutes", None):
        parser.error("--exact-minutes needs the offsets of a topic")
    return args


def run(spark: SparkSession, given: Sequence[str]) -> list[StreamingQuery]:
    """Start the job and return its queries; with ``--once`` they have ended."""
    return _run(spark, _arguments(given))


def _run(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    options = dict(pair.split("=", 1) for pair in args.option)
    root = sinks.checkpoint(spark, args.job, args.checkpoint, args.reset)
    every = None if args.once else args.every

    def source(name: str) -> DataFrame:
        if args.files:
            records = readers.text(spark, name, topic=name, streaming=True)
        else:
            records = readers.kafka(spark, args.servers, name, args.start or "latest", options)
        return readers.since(records, args.since)

    def sink(name: str, encode: Callable[[DataFrame], DataFrame]) -> sinks.Sink:
        """Result rows as a table, or encoded as messages."""
        if args.files:
            return sinks.to_parquet(name)
        return sinks.to_messages(args.servers, name, encode, options)

    def updates(name: str) -> sinks.Sink:
        """Changed totals: a folder per micro-batch, or messages."""
        if args.files:
            return sinks.to_updates(name)
        return sinks.to_messages(args.servers, name, sinks.long_messages, options)

    def rejects() -> sinks.Sink | None:
        return sink(args.rejected, ticket_sales.rejected_messages) if args.rejected else None

    if args.job == "word-count" and args.changes:
        queries = [
            word_count.start_changes(
                source(args.input), args.output, every=every, partitions=args.partitions
            )
        ]
    elif args.job == "word-count":
        queries = [
            word_count.start(
                source(args.input),
                updates(args.output),
                checkpoint=root,
                every=every,
                partitions=args.partitions,
            )
        ]
    elif args.job == "ticket-sales":
        queries = list(
            ticket_sales.start(
                source(args.input),
                None if args.changes else updates(args.output),
                sink(args.minutes, ticket_sales.minute_messages)
                if args.minutes
                else sinks.to_console(),
                rejects(),
                sales_table=args.sales_table or f"{root}/sales",
                checkpoint_root=root,
                changes_root=args.output if args.changes else None,
                exact_root=args.exact_minutes,
                every=every,
                partitions=args.partitions,
            )
        )
    else:
        queries = list(
            rated_movies.start(
                source(args.movies),
                source(args.input),
                args.movie_table,
                sink(args.output, rated_movies.messages),
                checkpoint_root=root,
                every=every,
                salts=args.salts,
                rejected_sink=rejects(),
                partitions=args.partitions,
            )
        )
    if args.once:
        for query in queries:
            sinks.drain(query)
    return queries


def stop_on_signals(queries: Sequence[StreamingQuery]) -> None:
    """Let an interrupt or a termination stop the queries between micro-batches' commits."""

    def stop(number: int, _frame: object) -> None:
        for query in queries:
            query.stop()

    for number in (signal.SIGINT, signal.SIGTERM):
        signal.signal(number, stop)


def wait(queries: Sequence[StreamingQuery]) -> None:
    """Until every query has ended; if one fails the others are stopped and it is raised."""
    try:
        while any(query.isActive for query in queries):
            for query in queries:
                query.awaitTermination(1)
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def main() -> None:
    args = _arguments(None)
    spark = session.build("tidemark-jobs")
    queries = _run(spark, args)
    stop_on_signals(queries)
    wait(queries)


if __name__ == "__main__":
    main()

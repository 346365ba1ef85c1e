"""Command line: poll change logs into target or stage tables.

    spark-submit --py-files … -m tidemark COMMAND …

    cycle     one poll of each table into its target table
    stream    poll landing folders every five minutes
    stage     one poll of each table into its stage table, replaced or appended to
    maintain  merge and compact what is due; with --vacuum remove what nothing names
    query     ad-hoc SQL in a database, after a check of the connection

A log is ``FOLDER/<table>`` as parquet in stage form; with --dates partitioned by commit
date, with --times a raw change table, with --index of any layout.  With --database the
source is read over JDBC.  Contents of rows are never printed.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import DEFAULT_WATERMARK, SALES_TABLES, TableConfig, table_config
from tidemark.plans.cycle import maintain_tables, run_cycle, summarize
from tidemark.plans.logs import LogPlace
from tidemark.session import build_session
from tidemark.sinks.stage import (
    append_poll,
    last_poll,
    merge_polls,
    read_stage,
    replace_stage,
)
from tidemark.sinks.targets import TargetStore
from tidemark.sources import jdbc
from tidemark.sources.change_log import changes_after
from tidemark.streaming.poll import stream_tables


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark")
    commands = parser.add_subparsers(dest="command", required=True)
    tables = argparse.ArgumentParser(add_help=False)
    tables.add_argument("--root", required=True, help="folder of the tables")
    tables.add_argument("--table", action="append", help="default: all configured tables")
    marks = argparse.ArgumentParser(add_help=False)
    marks.add_argument("--since", type=datetime.fromisoformat, default=DEFAULT_WATERMARK)
    marks.add_argument("--exact", action="store_true", help="compare marks in microseconds")
    logs = argparse.ArgumentParser(add_help=False)
    logs.add_argument("--logs", help="folder with one change log per table")
    logs.add_argument("--database", help="read this source over JDBC instead")
    logs.add_argument("--dates", help="partition column with the commit date")
    logs.add_argument("--times", help="log positions and commit times of raw logs")
    logs.add_argument("--index", help="folder for indexes of the logs' files")

    cycle = commands.add_parser("cycle", parents=[tables, marks, logs])
    cycle.add_argument("--no-reread", action="store_true", help="apply no change twice")
    stream = commands.add_parser("stream", parents=[tables, marks])
    stream.add_argument("--logs", required=True, help="folder with one landing folder per table")
    stream.add_argument("--once", action="store_true", help="take what is there and end")
    stage = commands.add_parser("stage", parents=[tables, marks, logs])
    stage.add_argument("--append", action="store_true", help="keep earlier polls")
    stage.add_argument("--to-database", help="load the batch into this database as well")
    maintain = commands.add_parser("maintain", parents=[tables])
    maintain.add_argument("--vacuum", type=float, metavar="HOURS")
    query = commands.add_parser("query")
    query.add_argument("--database", required=True)
    query.add_argument("--sql", required=True)
    query.add_argument("--out", required=True, help="folder for the rows, as parquet")
    return parser


def _stage(spark: SparkSession, table: TableConfig, args: argparse.Namespace) -> None:
    """One poll of a table into its stage: appended with before-images, its own newest
    time the mark, or replaced by what is newer than ``since``."""
    path = f"{args.root}/{table.name}"
    place = LogPlace(args.logs, args.database, args.dates, args.times, args.index)
    log = place.log(spark, table, before_images=args.append)
    if args.append:
        poll = last_poll(spark, path) + 1
        append_poll(spark, path, log, table, poll, args.since, args.exact)
        merge_polls(spark, path, table)
        return
    batch = changes_after(log, args.since) if isinstance(log, DataFrame) else log(args.since)
    replace_stage(batch, path, table)
    if args.to_database:
        jdbc.write_stage_table(read_stage(spark, path, table), args.to_database, table, True)


def main(arguments: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = build_session()
    if args.command == "query":
        jdbc.precheck(spark, args.database)
        jdbc.read_query(spark, args.database, args.sql).write.parquet(args.out)
        return
    tables = [table_config(name) for name in args.table or SALES_TABLES]
    if args.command == "stage":
        for table in tables:
            _stage(spark, table, args)
        return
    store = TargetStore(spark, args.root)
    if args.command == "maintain":
        maintain_tables(store, tables)
        if args.vacuum is not None:
            for table in tables:
                store.vacuum(table, args.vacuum)
    elif args.command == "stream":
        trigger = {"availableNow": True} if args.once else None
        checkpoints = f"{args.root}/checkpoints"
        queries = stream_tables(
            store, args.logs, tables, checkpoints, trigger, args.since, args.exact
        )
        if args.once:
            for query in queries:
                query.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
    else:
        place = LogPlace(args.logs, args.database, args.dates, args.times, args.index)
        logs = {t.name: place.log(spark, t) for t in tables}
        run_cycle(
            store, logs, default=args.since, exact=args.exact, no_reread=args.no_reread
        )
        summarize(store, tables).show(truncate=False)


if __name__ == "__main__":
    main()

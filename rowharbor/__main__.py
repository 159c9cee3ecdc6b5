"""Starting the jobs with spark-submit; ``--help`` lists them."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from rowharbor.operators.settings import pipeline_actions, pipeline_settings
from rowharbor.plans.jobs import (
    TABLES_AT_ONCE,
    copy_tables,
    follow_log,
    land_log,
    prepare_lookup,
)
from rowharbor.sinks.dataset import KEEP_HOURS, compact_landings, remove_unused
from rowharbor.sources.change_log import read_text_log, read_typed_log
from rowharbor.sources.database import read_catalog, read_table
from rowharbor.streaming.landing import FLUSH_INTERVAL_MS, flush_limits
from rowharbor.work_dir import remove_old_work, work_dir


def first_line(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0].split("\n")[0].strip()


def database_options(spark: SparkSession, args: argparse.Namespace) -> dict[str, str]:
    password = first_line(spark, args.password_file)
    return {"url": args.url, "user": args.user, "password": password}


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="rowharbor")
    jobs = parser.add_subparsers(dest="job", required=True)

    catalog = jobs.add_parser("catalog", help="store a publication's columns")
    catalog.add_argument("--url", required=True)
    catalog.add_argument("--user", required=True)
    catalog.add_argument("--password-file", required=True, help="its first line")
    catalog.add_argument("--publication", required=True)
    catalog.add_argument("--columns", required=True, help="directory to write")

    copy = jobs.add_parser("copy", help="land the initial copies of all tables")
    copy.add_argument("--url", required=True)
    copy.add_argument("--user", required=True)
    copy.add_argument("--password-file", required=True, help="its first line")
    copy.add_argument("--columns", required=True, help="what 'catalog' stored")
    copy.add_argument("--root", required=True, help="dataset of change tables")
    copy.add_argument("--name", required=True, help="name of the landings")
    copy.add_argument("--tables-at-once", type=int, default=TABLES_AT_ONCE)

    for name, about in (("land", "land a log once"), ("follow", "land it as a stream")):
        job = jobs.add_parser(name, help=about)
        job.add_argument("--log", required=True)
        job.add_argument("--format", default="parquet")
        job.add_argument("--typed", action="store_true")
        job.add_argument("--columns", required=True, help="what 'catalog' stored")
        job.add_argument("--root", required=True, help="dataset of change tables")
        job.add_argument("--name", required=True, help="name of landing or stream")
        job.add_argument("--compact", action="store_true")
        if name == "follow":
            job.add_argument("--checkpoints", required=True)
            job.add_argument("--interval-ms", type=int, default=FLUSH_INTERVAL_MS)
            job.add_argument("--max-files", type=int)
            job.add_argument("--max-bytes", type=int)
            job.add_argument("--once", action="store_true")
            job.add_argument("--rejects", action="store_true", help="keep what is not landed")
            job.add_argument("--offsets", help="table of positions to keep")
            job.add_argument("--max-rows", type=int, help="most records of a piece")
            job.add_argument("--tables", help="database to show the change tables in")

    compact = jobs.add_parser("compact", help="make a dataset's landings one")
    compact.add_argument("--root", required=True, help="dataset of change tables")
    compact.add_argument("--keep-hours", type=float, default=KEEP_HOURS, help="for open readers")

    clean = jobs.add_parser("clean", help="delete old work folders under spark.checkpoint.dir")
    clean.add_argument("--hours", type=float, required=True, help="older than this")

    actions = jobs.add_parser("actions", help="compare two versions of the settings")
    actions.add_argument("--running", required=True)
    actions.add_argument("--desired", required=True)
    actions.add_argument("--out", required=True)
    return parser


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "catalog":
        options = database_options(spark, args)
        columns = read_catalog(spark, options, args.publication)
        columns.write.mode("overwrite").parquet(args.columns)
        return
    if args.job == "clean":
        remove_old_work(spark, args.hours)
        return
    if args.job == "compact":
        compact_landings(spark, args.root)
        remove_unused(spark, args.root, args.keep_hours)
        return
    if args.job == "actions":
        running, desired = (
            pipeline_settings(spark.read.parquet(path))
            for path in (args.running, args.desired)
        )
        pipeline_actions(running, desired).write.mode("overwrite").parquet(args.out)
        return

    columns = spark.read.parquet(args.columns)
    lookup = prepare_lookup(columns, work_dir(spark, "lookup"))
    if args.job == "copy":
        options = database_options(spark, args)
        copy_tables(
            lambda table: read_table(spark, options, table),
            lookup,
            args.root,
            args.name,
            at_once=args.tables_at_once,
        )
        return
    read = read_typed_log if args.typed else read_text_log
    if args.job == "land":
        log = read(spark, args.log, args.format)
        land_log(log, lookup, args.root, args.name, compact=args.compact)
        return
    limits = flush_limits(args.max_files, args.max_bytes)
    follow_log(
        read(spark, args.log, args.format, streaming=True, options=limits),
        lookup,
        args.root,
        args.name,
        args.checkpoints,
        once=args.once,
        compact=args.compact,
        interval_ms=args.interval_ms,
        rejects=args.rejects,
        offsets=args.offsets,
        most_rows=args.max_rows,
        tables=args.tables,
    ).awaitTermination()


def main() -> None:
    spark = SparkSession.builder.appName("rowharbor").getOrCreate()
    run(spark, arguments().parse_args())


if __name__ == "__main__":
    main()

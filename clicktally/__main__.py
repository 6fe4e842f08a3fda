"""The jobs as commands: ``python -m clicktally <job> ...``, or this file with spark-submit."""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from clicktally.plans.jobs import (
    append_click_statistics,
    append_conversion_statistics,
    run_bucketed_click_consolidation,
    run_bucketed_conversion_consolidation,
    run_click_consolidation,
    run_click_search,
    run_click_statistics,
    run_conversion_consolidation,
    run_conversion_statistics,
    run_copy_search,
)
from clicktally.plans.late_files import run_late_hours
from clicktally.plans.refresh import run_conversion_refresh
from clicktally.schemas import (
    CLICK_DAILY,
    CLICK_SNAPSHOT,
    CONVERSION_DAILY,
    CONVERSION_LOG,
    CONVERSION_SNAPSHOT,
)
from clicktally.session import build_session
from clicktally.sinks import BucketedDays, read_snapshots
from clicktally.sources import ClickLayout, read_conversion_log, write_click_copy
from clicktally.streaming import (
    CLICKS,
    CONVERSIONS,
    run_click_stream,
    run_latest_stream,
    run_stateful_stream,
)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clicktally")
    jobs = parser.add_subparsers(dest="job", required=True)

    def add(name: str, help_text: str, *required: str) -> argparse.ArgumentParser:
        job = jobs.add_parser(name, help=help_text)
        job.add_argument("--as-of", type=datetime.fromisoformat, help="batch time, now if absent")
        for argument in required:
            job.add_argument(f"--{argument}", required=True)
        return job

    def database(job: argparse.ArgumentParser) -> None:
        """Where results go: a folder or a database."""
        sink = job.add_mutually_exclusive_group(required=True)
        sink.add_argument("--snapshots", help="folder of the snapshots")
        sink.add_argument("--out-url", help="JDBC address of the database of the snapshots")
        job.add_argument("--out-properties", help="JSON file with driver and credentials")
        job.add_argument("--rejects")

    clicks = add("click-statistics", "count the clicks of the hour", "root")
    database(clicks)
    conversions = add("conversion-statistics", "sum up the conversions of the day")
    database(conversions)
    conversions.add_argument("--values", help="folder for the distinct values as rows")
    conversions.add_argument("--jdbc-slices", type=int, default=24)
    source = conversions.add_mutually_exclusive_group(required=True)
    source.add_argument("--log", help="the conversion log as Parquet")
    source.add_argument("--jdbc-url")
    conversions.add_argument("--jdbc-table", default="conversion_log")
    conversions.add_argument("--jdbc-properties", help="JSON file with driver and credentials")
    for mode, what in (("clicks", "offer"), ("conversions", "type and offer")):
        job = add(
            f"consolidate-{mode}",
            f"keep the latest snapshot per day and {what}",
            "snapshots",
            "daily",
        )
        kind = job.add_mutually_exclusive_group(required=True)
        kind.add_argument("--staging", help="folder in which days are staged")
        kind.add_argument("--buckets", type=int, help="the daily table is in so many buckets")
        job.add_argument("--progress", help="read only snapshots that are new since the last run, noted here")
        job.add_argument("--delay", default="2 days", help="days stay open this long with --progress")
        job.add_argument("--rejects")
    search = add("search", "find the clicks of the day with a destination subid", "root", "out")
    search.add_argument("subid")
    search.add_argument("--rejects")
    search.add_argument("--copy", help="folder of a cleaned copy to search instead of the files")
    late = add("late-hours", "count the hours that got files after their count", "root", "snapshots", "ledger")
    late.add_argument("--rejects")
    late.add_argument("--days", type=int, default=2, help="days to look back")
    copy = add("copy", "copy the clicks of the day for searches", "root", "copy")
    copy.add_argument("--rejects")
    refresh = add(
        "conversion-refresh", "sum up what was loaded since the last run", "log", "snapshots", "totals"
    )
    refresh.add_argument("--rejects")
    stream = add(
        "stream", "count the click files that are new", "root", "partials", "snapshots", "progress"
    )
    stream.add_argument("--rejects")
    stream.add_argument("--delay", help="keep the counts in the state store, and hours open this long")
    return parser


def _properties(file_name: str | None) -> dict[str, str]:
    if file_name is None:
        return {}
    with open(file_name) as file:
        return json.load(file)


def _conversion_log(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    if options.log:
        return spark.read.parquet(options.log).select(*CONVERSION_LOG.names)
    properties = _properties(options.jdbc_properties)
    return read_conversion_log(
        spark,
        options.jdbc_url,
        options.jdbc_table,
        options.as_of,
        properties,
        slices=options.jdbc_slices,
    )


def main(arguments: list[str] | None = None) -> None:
    parser = _parser()
    options = parser.parse_args(arguments)
    if options.job.startswith("consolidate") and options.progress and options.buckets:
        parser.error("--progress needs --staging")
    if options.as_of is None:
        options.as_of = datetime.now(timezone.utc)
    spark = build_session(f"clicktally {options.job}")
    as_of = options.as_of
    if options.job == "click-statistics" and options.out_url:
        properties = _properties(options.out_properties)
        layout = ClickLayout(options.root)
        append_click_statistics(spark, layout, as_of, options.out_url, properties)
    elif options.job == "click-statistics":
        layout = ClickLayout(options.root)
        rejected = run_click_statistics(
            spark, layout, as_of, options.snapshots, options.rejects
        )
        print(f"{rejected} lines rejected")
    elif options.job == "conversion-statistics" and options.out_url:
        properties = _properties(options.out_properties)
        log = _conversion_log(spark, options)
        append_conversion_statistics(log, as_of, options.out_url, properties)
    elif options.job == "conversion-statistics":
        log = _conversion_log(spark, options)
        run_conversion_statistics(
            log, as_of, options.snapshots, options.rejects, values_path=options.values
        )
    elif options.job.startswith("consolidate") and options.progress:
        run_latest_stream(
            spark,
            CLICKS if options.job == "consolidate-clicks" else CONVERSIONS,
            options.snapshots,
            options.daily,
            options.staging,
            options.progress,
            options.delay,
            rejects_path=options.rejects,
        ).awaitTermination()
    elif options.job == "consolidate-clicks" and options.buckets:
        rows = read_snapshots(spark, options.snapshots, CLICK_SNAPSHOT, as_of)
        table = BucketedDays(options.daily, CLICK_DAILY, options.buckets)
        run_bucketed_click_consolidation(rows, as_of, table, options.rejects)
    elif options.job == "consolidate-conversions" and options.buckets:
        rows = read_snapshots(spark, options.snapshots, CONVERSION_SNAPSHOT, as_of)
        table = BucketedDays(options.daily, CONVERSION_DAILY, options.buckets)
        run_bucketed_conversion_consolidation(rows, as_of, table, options.rejects)
    elif options.job == "consolidate-clicks":
        rows = read_snapshots(spark, options.snapshots, CLICK_SNAPSHOT, as_of)
        run_click_consolidation(rows, as_of, options.daily, options.staging, options.rejects)
    elif options.job == "consolidate-conversions":
        rows = read_snapshots(spark, options.snapshots, CONVERSION_SNAPSHOT, as_of)
        run_conversion_consolidation(
            rows, as_of, options.daily, options.staging, options.rejects
        )
    elif options.job == "late-hours":
        hours = run_late_hours(
            spark,
            ClickLayout(options.root),
            as_of - timedelta(days=options.days),
            as_of,
            options.snapshots,
            options.ledger,
            options.rejects,
        )
        print(f"{len(hours)} hours counted")
    elif options.job == "copy":
        layout = ClickLayout(options.root)
        write_click_copy(spark, layout, layout.day_glob(as_of), options.copy, options.rejects)
    elif options.job == "conversion-refresh":
        log = _conversion_log(spark, options)
        run_conversion_refresh(log, as_of, options.snapshots, options.totals, options.rejects)
    elif options.job == "search" and options.copy:
        found = run_copy_search(spark, options.copy, as_of, options.subid)
        found.write.mode("overwrite").csv(options.out)
    elif options.job == "search":
        found = run_click_search(
            spark, ClickLayout(options.root), as_of, options.subid, options.rejects
        )
        found.write.mode("overwrite").csv(options.out)
    elif options.job == "stream" and options.delay:
        run_stateful_stream(
            spark,
            ClickLayout(options.root),
            options.partials,
            options.snapshots,
            options.progress,
            options.delay,
            rejects_path=options.rejects,
        ).awaitTermination()
    elif options.job == "stream":
        run_click_stream(
            spark,
            ClickLayout(options.root),
            options.partials,
            options.snapshots,
            options.progress,
            rejects_path=options.rejects,
        ).awaitTermination()


if __name__ == "__main__":
    main()

"""Click files that arrive after their hour was counted: found by a ledger, recounted by the hour.

The ledger holds path, length and time of every file that a count has seen, in one folder per day. A run
lists the files of a range of hours, keeps those that the ledger does not hold in this form, and counts
the hours of these anew, whole; other hours are not read. The files are noted after the snapshots of their
hours are stored. A run that dies in between leaves the ledger as it was, and the next one counts
the same hours again, to the same result. A file that arrives between the listing and the reading is
counted and not noted, so its hour is counted once more.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.functions import as_utc, day_key
from clicktally.operators.clicks import click_counts_by_hour, click_rejects, parse_clicks
from clicktally.plans.jobs import fitting_rows
from clicktally.plans.rejects import write_rejects
from clicktally.plans.whole_files import over_whole_files
from clicktally.schemas import CLICK_SNAPSHOT
from clicktally.session import delete_path, fresh_path
from clicktally.sinks import write_snapshots
from clicktally.sources import ClickLayout, list_click_files

FILE = ("path", "length", "modified")
LEDGER_SCHEMA = "path string, length long, modified timestamp, hour string, day string"

# Fixed value: the time format of the hour of a folder.
HOUR_FORMAT = "%Y/%m/%d/%H"


def read_ledger(spark: SparkSession, path: str, first: datetime, last: datetime) -> DataFrame:
    """The files noted for the days from ``first`` to ``last`` (other folders unread)."""
    try:
        rows = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return rows.filter(F.col("day").between(day_key(first), day_key(last)))


def note_files(files: DataFrame, path: str) -> None:
    """Add files to the ledger; one that is noted twice is held twice, to no effect."""
    day = F.translate(F.substring("hour", 1, 10), "/", "-")
    rows = files.select(*FILE, "hour", day.alias("day"))
    rows.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(path)


def uncounted_files(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """The listed files that the ledger does not hold with this length and time."""
    return listed.join(ledger.select(*FILE), list(FILE), "left_anti")


def _hours_between(first: datetime, last: datetime) -> Iterable[str]:
    hour = as_utc(first).replace(minute=0, second=0)
    while hour <= as_utc(last):
        yield hour.strftime(HOUR_FORMAT)
        hour += timedelta(hours=1)


def run_late_hours(
    spark: SparkSession,
    layout: ClickLayout,
    first: datetime,
    last: datetime,
    snapshots_path: str,
    ledger_path: str,
    rejects_path: str | None = None,
) -> list[str]:
    """Count the hours from ``first`` to ``last`` that have files which no run has counted.

    Returns these hours, as ``yyyy/MM/dd/HH``. Each gets the snapshot of its last minute, the one that
    ``run_click_history`` stores; a snapshot that is left without rows is emptied. A file that was changed
    counts as new, one that was deleted changes nothing. With a path for rejects the files of the hours
    are read twice, and files that break off are left out of the count and of the ledger, so their hour
    is counted again by every run until they are whole.
    """
    listing = fresh_path(spark, "click-files")
    list_click_files(spark, layout, layout.range_glob(first, last)).write.parquet(listing)
    listed = spark.read.parquet(listing)
    ledger = read_ledger(spark, ledger_path, first, last)
    # No more than the hours of the range.
    found = uncounted_files(listed, ledger).select("hour").distinct()
    hours = sorted({row.hour for row in found.collect()} & set(_hours_between(first, last)))
    if hours:
        times = [datetime.strptime(hour, HOUR_FORMAT) for hour in hours]
        run = f"{hours[0]}_{hours[-1]}_{len(hours)}".replace("/", "-")
        keys = [f"{time:%Y-%m-%d %H}:59" for time in times]

        def count(lines: DataFrame) -> None:
            counts = click_counts_by_hour(parse_clicks(lines))
            with fitting_rows(counts, CLICK_SNAPSHOT, rejects_path, run) as rows:
                write_snapshots(rows, snapshots_path, CLICK_SNAPSHOT, F.col("key_dt").isin(keys))
            if rejects_path is not None:
                write_rejects(click_rejects(lines), f"{rejects_path}/lines", run)

        glob = layout.hours_glob(times)
        _, broken = over_whole_files(spark, layout, glob, rejects_path, run, count)
        counted = listed.filter(F.col("hour").isin(hours) & ~F.col("path").isin(broken))
        note_files(uncounted_files(counted, ledger), ledger_path)
    delete_path(spark, listing)
    return hours

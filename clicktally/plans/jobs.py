"""The batch jobs, from source to sink."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clicktally.functions import as_utc, minute_key
from clicktally.operators.checks import require_contract, split_by_contract
from clicktally.operators.clicks import (
    click_counts,
    click_counts_by_hour,
    click_rejects,
    parse_clicks,
    search_clicks,
)
from clicktally.operators.conversions import (
    by_type,
    conversion_rejects,
    conversion_snapshot,
    conversion_snapshots_by_day,
    dimension_values,
    in_either_window,
    window_marks,
)
from clicktally.operators.latest import (
    latest_clicks,
    latest_conversions,
    since_today,
    snapshot_rejects,
)
from clicktally.operators.upsert import upsert
from clicktally.plans.rejects import write_rejects
from clicktally.plans.whole_files import over_whole_files
from clicktally.schemas import (
    CLICK_DAILY,
    CLICK_SNAPSHOT,
    CLICK_UPDATES,
    CONVERSION_DAILY,
    CONVERSION_SNAPSHOT,
    CONVERSION_UPDATES,
    TableContract,
)
from clicktally.session import delete_path, fresh_path
from clicktally.sinks import (
    BucketedDays,
    append_rows,
    finish_replacements,
    key_code,
    read_bucketed_days,
    read_daily,
    stage_and_replace,
    upsert_rows,
    write_bucketed_days,
    write_run,
    write_snapshots,
)
from clicktally.sinks.bucketed import KEY_CODE
from clicktally.sources import ClickLayout, read_click_copy, read_click_lines


def _run_name(*times: datetime) -> str:
    return "_".join(as_utc(time).strftime("%Y-%m-%dT%H%M") for time in times)


@contextmanager
def fitting_rows(
    rows: DataFrame,
    contract: TableContract,
    rejects_path: str | None,
    run: str,
    session: SparkSession | None = None,
) -> Iterator[DataFrame]:
    """Rows that keep the contract of their table; with a path, the others go to the rejects.

    Without a path a violation ends the run. The rows are stored first, so that they are computed
    once, and the copy is deleted when the block ends. ``session`` reads it, if another one than theirs.
    """
    spark = session or rows.sparkSession
    stored = fresh_path(spark, contract.name)
    try:
        rows.select(*contract.columns).write.parquet(stored)
        rows = spark.read.schema(contract.schema).parquet(stored)
        if rejects_path is None:
            require_contract(rows, contract)
            yield rows
        else:
            fitting, broken = split_by_contract(rows, contract)
            write_rejects(broken, f"{rejects_path}/{contract.name}", run)
            yield fitting
    finally:
        delete_path(spark, stored)


def run_click_statistics(
    spark: SparkSession,
    layout: ClickLayout,
    as_of: datetime,
    snapshots_path: str,
    rejects_path: str | None = None,
) -> int:
    """Count the clicks of the hour of ``as_of``, store the snapshot, return the lines rejected.

    The files are read again for the rejects only if there are any and a path is given. Then files
    that break off are left out too. The number is exact unless a lost task was run again.
    """
    run = _run_name(as_of)

    def count(lines: DataFrame) -> int:
        seen, parsed = Observation(), Observation()
        clicks = parse_clicks(lines.observe(seen, F.count("*").alias("lines")))
        clicks = clicks.observe(parsed, F.count("*").alias("clicks"))
        with fitting_rows(click_counts(clicks, as_of), CLICK_SNAPSHOT, rejects_path, run) as counts:
            write_run(counts, snapshots_path, as_of)
        rejected = seen.get["lines"] - parsed.get["clicks"]
        if rejects_path is not None:
            found = click_rejects(lines) if rejected else click_rejects(lines.limit(0))
            write_rejects(found, f"{rejects_path}/lines", run)
        return rejected

    glob = layout.hour_glob(as_of)
    rejected, _ = over_whole_files(spark, layout, glob, rejects_path, run, count)
    return rejected


def run_click_history(
    spark: SparkSession,
    layout: ClickLayout,
    first: datetime,
    last: datetime,
    snapshots_path: str,
    rejects_path: str | None = None,
) -> None:
    """Store the last snapshot of every hour from ``first`` to ``last``, in one pass.

    An hour has one folder, whichever run stores it; hours without clicks are left empty. With a path
    for rejects the files are read twice, and those that break off are left out.
    """
    run = _run_name(first, last)
    hours = F.substring("key_dt", 1, 13).between(minute_key(first)[:13], minute_key(last)[:13])
    at_end = F.substring("key_dt", 15, 2) == "59"

    def count(lines: DataFrame) -> None:
        counts = click_counts_by_hour(parse_clicks(lines))
        with fitting_rows(counts, CLICK_SNAPSHOT, rejects_path, run) as fitting:
            write_snapshots(fitting, snapshots_path, CLICK_SNAPSHOT, hours & at_end)
        if rejects_path is not None:
            write_rejects(click_rejects(lines), f"{rejects_path}/lines", run)

    over_whole_files(spark, layout, layout.range_glob(first, last), rejects_path, run, count)


def run_conversion_history(
    log: DataFrame, snapshots_path: str, rejects_path: str | None = None
) -> None:
    """Store the last snapshot of every day of the log, in one pass; days without any are emptied."""
    snapshots = conversion_snapshots_by_day(log)
    at_end = F.substring("key_dt", 12, 5) == "23:59"
    with fitting_rows(snapshots, CONVERSION_SNAPSHOT, rejects_path, "history") as rows:
        write_snapshots(rows, snapshots_path, CONVERSION_SNAPSHOT, at_end)
    if rejects_path is not None:
        write_rejects(conversion_rejects(log), f"{rejects_path}/conversions", "history")


def run_conversion_statistics(
    log: DataFrame,
    as_of: datetime,
    snapshots_path: str,
    rejects_path: str | None = None,
    since: datetime | None = None,
    values_path: str | None = None,
) -> None:
    """Store the snapshot of the day so far on both clocks, in one write.

    With a path for rejects or for the values of the dimensions the log is scanned once more for each.
    The values are rows of type, offer, dimension and value, whatever their number.
    """
    run = _run_name(as_of)
    snapshot = conversion_snapshot(log, as_of, since)
    with fitting_rows(snapshot, CONVERSION_SNAPSHOT, rejects_path, run) as rows:
        write_run(rows, snapshots_path, as_of)
    seen = log.filter(in_either_window(log, as_of, since))
    if rejects_path is not None:
        write_rejects(conversion_rejects(seen), f"{rejects_path}/conversions", run)
    if values_path is not None:
        marks = window_marks(log, as_of, since)
        values = dimension_values(by_type(seen, marks), "key_type")
        values.write.mode("overwrite").parquet(f"{values_path}/run={run}")


def _consolidate(
    snapshots: DataFrame,
    latest: DataFrame,
    offer: str,
    target_path: str,
    staging_path: str,
    contract: TableContract,
    changed: tuple[str, ...],
    as_of: datetime,
    rejects_path: str | None,
) -> None:
    """Upsert into the days from that of ``as_of`` on, staging them before they are replaced.

    A replacement that an earlier run left unfinished is finished before the table is read.
    """
    spark = latest.sparkSession
    staging = f"{staging_path}/{contract.name}"
    finish_replacements(spark, staging, target_path, contract)
    target = read_daily(spark, target_path, contract, as_of)
    run = _run_name(as_of)
    # The days in the table keep the contract already, so only what is new is checked.
    with fitting_rows(latest, contract, rejects_path, run) as rows:
        merged = upsert(target, rows, contract.key, changed)
        stage_and_replace(merged, staging, run, target_path, contract)
    if rejects_path is not None:
        write_rejects(snapshot_rejects(snapshots, offer), f"{rejects_path}/snapshots", run)


def run_click_consolidation(
    snapshots: DataFrame,
    as_of: datetime,
    target_path: str,
    staging_path: str,
    rejects_path: str | None = None,
) -> None:
    """Upsert the latest click snapshot per day and offer, from the day of ``as_of`` on."""
    today = since_today(snapshots, as_of)
    _consolidate(
        today,
        latest_clicks(today),
        "offer_id",
        target_path,
        staging_path,
        CLICK_DAILY,
        CLICK_UPDATES,
        as_of,
        rejects_path,
    )


def run_conversion_consolidation(
    snapshots: DataFrame,
    as_of: datetime,
    target_path: str,
    staging_path: str,
    rejects_path: str | None = None,
) -> None:
    """Upsert the latest conversion snapshot per day, type and offer."""
    today = since_today(snapshots, as_of)
    _consolidate(
        today,
        latest_conversions(today),
        "offerid",
        target_path,
        staging_path,
        CONVERSION_DAILY,
        CONVERSION_UPDATES,
        as_of,
        rejects_path,
    )


def _consolidate_in_buckets(
    snapshots: DataFrame,
    latest: DataFrame,
    offer: str,
    table: BucketedDays,
    changed: tuple[str, ...],
    as_of: datetime,
    rejects_path: str | None,
) -> None:
    """Upsert into a table in buckets, of which the days from that of ``as_of`` on are read in place."""
    spark, contract = latest.sparkSession, table.contract
    run = _run_name(as_of)
    with fitting_rows(latest, contract, rejects_path, run) as rows:
        target = read_bucketed_days(spark, table, as_of)
        updates = rows.withColumn(KEY_CODE, key_code(contract))
        merged = upsert(target, updates, contract.key, changed, KEY_CODE)
        write_bucketed_days(merged, table, as_of)
    if rejects_path is not None:
        write_rejects(snapshot_rejects(snapshots, offer), f"{rejects_path}/snapshots", run)


def run_bucketed_click_consolidation(
    snapshots: DataFrame, as_of: datetime, table: BucketedDays, rejects_path: str | None = None
) -> None:
    """``run_click_consolidation`` into a table in buckets, whose rows are not shuffled for it."""
    today = since_today(snapshots, as_of)
    _consolidate_in_buckets(
        today, latest_clicks(today), "offer_id", table, CLICK_UPDATES, as_of, rejects_path
    )


def run_bucketed_conversion_consolidation(
    snapshots: DataFrame, as_of: datetime, table: BucketedDays, rejects_path: str | None = None
) -> None:
    """``run_conversion_consolidation`` into a table in buckets, whose rows are not shuffled for it."""
    today = since_today(snapshots, as_of)
    _consolidate_in_buckets(
        today, latest_conversions(today), "offerid", table, CONVERSION_UPDATES, as_of, rejects_path
    )


def append_click_statistics(
    spark: SparkSession,
    layout: ClickLayout,
    as_of: datetime,
    url: str,
    properties: dict[str, str],
) -> None:
    """Count the clicks of the hour of ``as_of`` and append them to the table of snapshots."""
    lines = read_click_lines(spark, layout, layout.hour_glob(as_of))
    append_rows(click_counts(parse_clicks(lines), as_of), url, CLICK_SNAPSHOT, properties)


def append_conversion_statistics(
    log: DataFrame,
    as_of: datetime,
    url: str,
    properties: dict[str, str],
    since: datetime | None = None,
) -> None:
    """Append the snapshot of the day so far on both clocks to the table of snapshots."""
    append_rows(conversion_snapshot(log, as_of, since), url, CONVERSION_SNAPSHOT, properties)


def upsert_click_days(
    snapshots: DataFrame,
    as_of: datetime,
    url: str,
    execute: Callable[[str], None],
    properties: dict[str, str],
    dialect: str = "mysql",
) -> None:
    """Upsert the latest click snapshot per day and offer into the daily table."""
    latest = latest_clicks(since_today(snapshots, as_of))
    upsert_rows(latest, url, execute, CLICK_DAILY, CLICK_UPDATES, properties, dialect)


def upsert_conversion_days(
    snapshots: DataFrame,
    as_of: datetime,
    url: str,
    execute: Callable[[str], None],
    properties: dict[str, str],
    dialect: str = "mysql",
) -> None:
    """Upsert the latest conversion snapshot per day, type and offer into the daily table."""
    latest = latest_conversions(since_today(snapshots, as_of))
    upsert_rows(latest, url, execute, CONVERSION_DAILY, CONVERSION_UPDATES, properties, dialect)


def run_click_search(
    spark: SparkSession,
    layout: ClickLayout,
    as_of: datetime,
    destination_subid: str,
    rejects_path: str | None = None,
) -> DataFrame:
    """Offer and advertiser of the clicks with a subid on the day of ``as_of``.

    With a path for rejects the files are read twice.
    """
    lines = read_click_lines(spark, layout, layout.day_glob(as_of))
    write_rejects(click_rejects(lines), rejects_path, _run_name(as_of))
    return search_clicks(parse_clicks(lines), destination_subid)


def run_copy_search(
    spark: SparkSession, copy_path: str, as_of: datetime, destination_subid: str
) -> DataFrame:
    """Offer and advertiser of the clicks with a subid on the day of ``as_of``, from the cleaned copy.

    The same as ``run_click_search`` for the hours that are copied; row groups without the id are skipped.
    """
    return search_clicks(read_click_copy(spark, copy_path, as_of), destination_subid)

"""The registered queries: every operator over the whole of its test table."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.functions import day_of_key
from clicktally.operators.checks import key_violations, width_violations
from clicktally.operators.clicks import (
    click_counts_by_hour,
    click_rejects,
    keep_long_keys,
    parse_clicks,
    search_clicks,
)
from clicktally.operators.conversions import (
    CLOCKS,
    DIMENSIONS,
    as_measures,
    conversion_rejects,
    conversion_snapshot,
    conversion_snapshots_by_day,
    conversions_in_window,
    dimension_sets,
    dimension_values,
    offer_totals,
    tag_conversions,
)
from clicktally.operators.latest import (
    latest_clicks,
    latest_conversions,
    since_today,
    snapshot_rejects,
)
from clicktally.operators.upsert import upsert
from clicktally.plans import inputs
from clicktally.plans.distinct_values import add_conversions, offer_value_counts, read_bitmaps
from clicktally.plans.jobs import (
    run_bucketed_click_consolidation,
    run_bucketed_conversion_consolidation,
    run_click_consolidation,
    run_click_history,
    run_click_search,
    run_click_statistics,
    run_conversion_consolidation,
    run_conversion_statistics,
)
from clicktally.plans.late_files import run_late_hours
from clicktally.plans.refresh import refresh_totals, totals_snapshot
from clicktally.schemas import (
    CLICK_DAILY,
    CLICK_SNAPSHOT,
    CLICK_UPDATES,
    CONVERSION_DAILY,
    CONVERSION_SNAPSHOT,
    CONVERSION_UPDATES,
    TableContract,
)
from clicktally.session import fresh_path
from clicktally.sinks import BucketedDays, read_bucketed_days, read_daily, read_snapshots
from clicktally.sources import read_click_copy, read_click_lines, write_click_copy
from clicktally.streaming import (
    CLICKS,
    CONVERSIONS,
    Consolidation,
    run_click_stream,
    run_latest_stream,
    run_stateful_stream,
)

Query = Callable[[SparkSession, str], DataFrame]

# A catch-up run: its window opens years before its batch time.
SINCE = datetime(1995, 6, 1)
AS_OF = datetime(2001, 6, 30, 12)
# A window that takes in every order line on either clock.
FIRST = datetime(1900, 1, 1)
LAST = datetime(2100, 1, 1)
# A consolidation run of the second week of the events.
TODAY = datetime(2024, 1, 8, 10, 35)
# The first events begin on this day; a consolidation as of it takes in all of them.
FIRST_DAY = datetime(2024, 1, 1)
# Batch times of the incremental refresh before the last one.
REFRESHES = (datetime(1996, 3, 1, 12), datetime(1998, 7, 9), datetime(2001, 10, 30, 6))
# Runs of one query that are started side by side.
JOBS_AT_ONCE = 6
SUBID = '{"k": 69}'


def _double(*names: str) -> dict[str, Column]:
    return {name: F.col(name).cast("double") for name in names}


def conversion_both_clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversion_snapshots_by_day(inputs.conversion_log(spark, sf_dir))


def conversion_catch_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversion_snapshot(inputs.conversion_log(spark, sf_dir), AS_OF, SINCE)


def _conversion_window(key_type: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        log = inputs.conversion_log(spark, sf_dir)
        rows = conversions_in_window(log, CLOCKS[key_type], AS_OF, SINCE)
        return rows.withColumns(_double("received_revenue", "paid_revenue"))

    return query


def _conversion_tag(key_type: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = tag_conversions(inputs.conversion_log(spark, sf_dir), key_type, AS_OF)
        return rows.withColumns(_double("received_revenue", "paid_revenue"))

    return query


def conversion_offer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = offer_totals(inputs.conversion_log(spark, sf_dir))
    return totals.withColumns(_double("received", "paid"))


def conversion_dimension_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension_sets(inputs.conversion_log(spark, sf_dir))


def conversion_dimension_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension_values(inputs.conversion_log(spark, sf_dir))


def conversion_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = offer_totals(inputs.conversion_log(spark, sf_dir))
    return totals.select("offer_id", *as_measures())


def conversion_without_offer(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.conversion_log(spark, sf_dir)
    returned = F.col("geo_country") == "R"
    holed = log.withColumn("offer_id", F.when(~returned, F.col("offer_id")))
    return conversion_rejects(holed).select(
        *DIMENSIONS.values(), *CLOCKS.values(), "reason"
    )


def click_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_clicks(inputs.click_lines(spark, sf_dir)).drop("ts")


def click_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_rejects(inputs.click_lines(spark, sf_dir)).drop("ts")


def click_key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_long_keys(inputs.clicks(spark, sf_dir))


def click_hour_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = inputs.write_click_files(spark, sf_dir)
    glob = layout.range_glob(*inputs.event_span(spark, sf_dir))
    return parse_clicks(read_click_lines(spark, layout, glob))


def click_day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = inputs.write_click_files(spark, sf_dir)
    glob = layout.range_glob(*inputs.event_span(spark, sf_dir))
    day = F.substring("hour", 1, 10).alias("day")
    return read_click_lines(spark, layout, glob).groupBy(day).agg(F.count("*").alias("lines"))


def click_stream_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = inputs.ClickLayout("")
    folder = F.concat_ws("/", layout.stream_of(F.col("ts")), "hour").alias("folder")
    rows = inputs.events(spark, sf_dir)
    return rows.groupBy(folder).agg(F.count("*").alias("clicks"))


def click_counts_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_counts_by_hour(inputs.clicks(spark, sf_dir))


def click_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_clicks(inputs.clicks(spark, sf_dir), SUBID)


def click_snapshot_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    return since_today(inputs.click_snapshots(spark, sf_dir), TODAY)


def conversion_snapshot_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    return since_today(inputs.conversion_snapshots(spark, sf_dir), TODAY)


def latest_click_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_clicks(inputs.click_snapshots(spark, sf_dir))


def latest_conversion_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_conversions(inputs.conversion_snapshots(spark, sf_dir))


def snapshot_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.click_snapshots(spark, sf_dir)
    kind = F.col("key_type")
    spoilt = rows.withColumns(
        {
            "key_dt": F.when(kind == "error", day_of_key(F.col("key_dt"))).otherwise(
                F.col("key_dt")
            ),
            "offer_id": F.when(kind != "view", F.col("offer_id")),
        }
    )
    return snapshot_rejects(spoilt, "offer_id")


def _earlier(snapshots: DataFrame) -> DataFrame:
    """What a run at four in the afternoon of each day finds."""
    return snapshots.filter(F.substring("key_dt", 12, 5) < "16:00")


def _later(snapshots: DataFrame) -> DataFrame:
    """What is left at the end of each day if snapshots before eight are gone."""
    return snapshots.filter(F.substring("key_dt", 12, 5) >= "08:00")


def _from_four(snapshots: DataFrame) -> DataFrame:
    """What arrives after four in the afternoon of each day."""
    return snapshots.filter(F.substring("key_dt", 12, 5) >= "16:00")


def upsert_click_consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.click_snapshots(spark, sf_dir)
    target, updates = latest_clicks(_earlier(rows)), latest_clicks(_later(rows))
    return upsert(target, updates, CLICK_DAILY.key, CLICK_UPDATES)


def upsert_conversion_consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.conversion_snapshots(spark, sf_dir)
    target, updates = latest_conversions(_earlier(rows)), latest_conversions(_later(rows))
    return upsert(target, updates, CONVERSION_DAILY.key, CONVERSION_UPDATES)


def _consolidation(
    snapshots: Callable[[SparkSession, str], DataFrame],
    run: Callable[..., None],
    contract: TableContract,
) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = snapshots(spark, sf_dir)
        target, staging = fresh_path(spark, contract.name), fresh_path(spark, "staging")
        for seen in (_earlier(rows), _later(rows)):
            run(seen, FIRST_DAY, target, staging)
        return read_daily(spark, target, contract)

    return query


def _bucketed_consolidation(
    snapshots: Callable[[SparkSession, str], DataFrame],
    run: Callable[..., None],
    contract: TableContract,
) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = snapshots(spark, sf_dir)
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        table = BucketedDays(fresh_path(spark, contract.name), contract, buckets)
        for seen in (_earlier(rows), _later(rows)):
            run(seen, FIRST_DAY, table)
        return read_bucketed_days(spark, table).select(*contract.columns)

    return query


def click_snapshot_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = inputs.write_click_files(spark, sf_dir)
    path = fresh_path(spark, CLICK_SNAPSHOT.name)
    run_click_history(spark, layout, *inputs.event_span(spark, sf_dir), path)
    return read_snapshots(spark, path, CLICK_SNAPSHOT)


def conversion_snapshot_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, CONVERSION_SNAPSHOT.name)
    log = inputs.conversion_log(spark, sf_dir)
    rejects = fresh_path(spark, "rejects")
    run_conversion_statistics(log, LAST, path, rejects, since=FIRST)
    stored = read_snapshots(spark, path, CONVERSION_SNAPSHOT)
    # Snapshots whose list of affiliates is longer than its column.
    set_aside = spark.read.parquet(f"{rejects}/{CONVERSION_SNAPSHOT.name}").drop("run")
    return stored.withColumn("reason", F.lit(None).cast("string")).unionByName(set_aside)


def key_violation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = click_counts_hour(spark, sf_dir)
    spoilt = F.when(F.col("key_type") != "error", F.col("offer_id"))
    return key_violations(rows.withColumn("offer_id", spoilt), CLICK_DAILY.key)


def width_violation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversion_snapshot(inputs.conversion_log(spark, sf_dir), LAST, FIRST)
    # Offers as long as names, so that more than one column is hit.
    named = F.concat(F.lit("an offer with a long name, no. "), F.col("offerid"))
    return width_violations(rows.withColumn("offerid", named), CONVERSION_SNAPSHOT)


def click_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The click job at the end of each hour of the last day, in the plain folder layout."""
    layout = inputs.write_click_files(spark, sf_dir, plain=True)
    path = fresh_path(spark, CLICK_SNAPSHOT.name)
    _, last = inputs.event_span(spark, sf_dir)

    def count(hour: int) -> None:
        as_of = last.replace(hour=hour, minute=59)
        run_click_statistics(spark, layout, as_of, path, fresh_path(spark, "rejects"))

    # The runs of different hours have nothing in common.
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        list(pool.map(count, range(last.hour + 1)))
    return read_snapshots(spark, path, CLICK_SNAPSHOT)


def click_late_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hours counted after a first delivery of files, and those of late files after a second."""
    snapshots, ledger = fresh_path(spark, CLICK_SNAPSHOT.name), fresh_path(spark, "ledger")
    span = inputs.event_span(spark, sf_dir)
    for layout in inputs.deliver_click_files(spark, sf_dir):
        run_late_hours(spark, layout, *span, snapshots, ledger)
    return read_snapshots(spark, snapshots, CLICK_SNAPSHOT)


def conversion_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs over a window that takes in the whole log, each from what was loaded since."""
    totals = fresh_path(spark, "totals")
    log = inputs.conversion_log(spark, sf_dir)
    for as_of in (*REFRESHES, LAST):
        refreshed = refresh_totals(log, totals, as_of, FIRST)
    return totals_snapshot(refreshed, LAST)


def conversion_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values per offer from the bitmaps of four loads of the whole log."""
    store = fresh_path(spark, "distinct-values")
    log = inputs.conversion_log(spark, sf_dir)
    before = FIRST
    for number, until in enumerate((*REFRESHES, LAST)):
        loaded = F.col("redshift_time")
        add_conversions(log.filter((loaded > before) & (loaded <= until)), store, f"load-{number}")
        before = until
    return offer_value_counts(read_bitmaps(spark, store))


def click_copy_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with an id in a cleaned copy of all click files."""
    layout = inputs.write_click_files(spark, sf_dir)
    path = fresh_path(spark, "click-copy")
    write_click_copy(spark, layout, layout.range_glob(*inputs.event_span(spark, sf_dir)), path)
    return search_clicks(read_click_copy(spark, path), SUBID).select(
        "offer_id", "offer_advertiser_id"
    )


def click_search_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search job over the last day, in the plain folder layout."""
    layout = inputs.write_click_files(spark, sf_dir, plain=True)
    _, last = inputs.event_span(spark, sf_dir)
    return run_click_search(spark, layout, last, SUBID, fresh_path(spark, "rejects"))


def _streamed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Snapshots and rejects of a stream of all files."""
    layout = inputs.write_click_files(spark, sf_dir)
    partials, snapshots, progress, rejects = (
        fresh_path(spark, name) for name in ("partials", "snapshots", "progress", "rejects")
    )
    run_click_stream(
        spark, layout, partials, snapshots, progress, rejects_path=rejects
    ).awaitTermination()
    return snapshots, rejects


def stream_click_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots, _ = _streamed(spark, sf_dir)
    return read_snapshots(spark, snapshots, CLICK_SNAPSHOT)


def stream_stateful_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = inputs.write_click_files(spark, sf_dir)
    paths = [fresh_path(spark, name) for name in ("layers", "snapshots", "progress")]
    # A month of files is delivered at once, so no hour is closed before the last.
    run_stateful_stream(spark, layout, *paths, delay="366 days").awaitTermination()
    return read_snapshots(spark, paths[1], CLICK_SNAPSHOT)


def _streamed_consolidation(
    snapshots: Callable[[SparkSession, str], DataFrame], kind: Consolidation
) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = snapshots(spark, sf_dir)
        arrived, *places = (
            fresh_path(spark, name) for name in ("snapshots", "daily", "staging", "progress")
        )
        for seen in (_earlier(rows), _from_four(rows)):
            seen.write.mode("append").parquet(arrived)
            # Each delivery is of all days, so no day is closed before the last.
            run_latest_stream(spark, kind, arrived, *places, delay="366 days").awaitTermination()
        return read_daily(spark, places[0], kind.daily)

    return query


def stream_click_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = _streamed(spark, sf_dir)
    return spark.read.parquet(rejects).select("value", "hour", "reason")


QUERIES: dict[str, Query] = {
    "conversion_both_clocks": conversion_both_clocks,
    "conversion_catch_up": conversion_catch_up,
    "conversion_window_c": _conversion_window("C"),
    "conversion_window_r": _conversion_window("R"),
    "conversion_tag_c": _conversion_tag("C"),
    "conversion_tag_r": _conversion_tag("R"),
    "conversion_offer_totals": conversion_offer_totals,
    "conversion_dimension_sets": conversion_dimension_sets,
    "conversion_dimension_values": conversion_dimension_values,
    "conversion_net": conversion_net,
    "conversion_rejects": conversion_without_offer,
    "click_parse": click_parse,
    "click_rejects": click_rejected,
    "click_key_filter": click_key_filter,
    "click_hour_scan": click_hour_scan,
    "click_day_scan": click_day_scan,
    "click_stream_parity": click_stream_parity,
    "click_counts_hour": click_counts_hour,
    "click_search": click_search,
    "click_snapshot_today": click_snapshot_today,
    "conversion_snapshot_today": conversion_snapshot_today,
    "latest_click_snapshot": latest_click_snapshot,
    "latest_conversion_snapshot": latest_conversion_snapshot,
    "snapshot_rejects": snapshot_rejected,
    "upsert_click_consolidate": upsert_click_consolidate,
    "upsert_conversion_consolidate": upsert_conversion_consolidate,
    "consolidate_clicks": _consolidation(
        inputs.click_snapshots, run_click_consolidation, CLICK_DAILY
    ),
    "consolidate_conversions": _consolidation(
        inputs.conversion_snapshots, run_conversion_consolidation, CONVERSION_DAILY
    ),
    "consolidate_clicks_bucketed": _bucketed_consolidation(
        inputs.click_snapshots, run_bucketed_click_consolidation, CLICK_DAILY
    ),
    "consolidate_conversions_bucketed": _bucketed_consolidation(
        inputs.conversion_snapshots, run_bucketed_conversion_consolidation, CONVERSION_DAILY
    ),
    "click_snapshot_append": click_snapshot_append,
    "conversion_snapshot_append": conversion_snapshot_append,
    "key_violations": key_violation,
    "width_violations": width_violation,
    "stream_click_counts": stream_click_counts,
    "stream_click_rejects": stream_click_rejects,
    "click_statistics_job": click_job,
    "click_search_job": click_search_job,
    "click_late_hours": click_late_hours,
    "click_copy_search": click_copy_search,
    "conversion_refresh": conversion_refresh,
    "conversion_distinct_counts": conversion_distinct_counts,
    "stream_stateful_counts": stream_stateful_counts,
    "stream_latest_clicks": _streamed_consolidation(inputs.click_snapshots, CLICKS),
    "stream_latest_conversions": _streamed_consolidation(
        inputs.conversion_snapshots, CONVERSIONS
    ),
}

"""Conversions: revenue, cost and their difference per offer, on two clocks.

``C`` counts a conversion when it happened, ``R`` when it was loaded into the warehouse.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktally.functions import as_utc, day_start, minute_key, time_literal
from clicktally.schemas import CONVERSION_SNAPSHOT

# Types of the two clocks and the separator of joined sets.
CLOCKS = {"C": "conversion_time", "R": "redshift_time"}
SEPARATOR = "#"

# Columns of the log whose distinct values a snapshot lists, by the name they get there.
DIMENSIONS = {"affiliates": "affiliate_id", "geo": "geo_country", "zones": "subid4"}


def in_window(
    log: DataFrame, clock: str, as_of: datetime, since: datetime | None = None
) -> Column:
    """Whether a clock lies between the start of the day and ``as_of``, both included."""
    kind = log.schema[clock].dataType
    start = day_start(as_of) if since is None else as_utc(since)
    return F.col(clock).between(time_literal(start, kind), time_literal(as_of, kind))


def in_either_window(log: DataFrame, as_of: datetime, since: datetime | None = None) -> Column:
    """Whether a conversion happened or was loaded in the window; can be pushed to a scan."""
    return reduce(or_, (in_window(log, clock, as_of, since) for clock in CLOCKS.values()))


def conversions_in_window(
    log: DataFrame, clock: str, as_of: datetime, since: datetime | None = None
) -> DataFrame:
    """The columns that a run needs of the conversions in its window."""
    return log.filter(in_window(log, clock, as_of, since)).select(
        "received_revenue", "offer_id", "paid_revenue", *DIMENSIONS.values()
    )


def tag_conversions(log: DataFrame, key_type: str, as_of: datetime) -> DataFrame:
    """Conversions as snapshot input: type, batch time, one count each, ids as text."""
    return log.select(
        F.lit(key_type).alias("key_type"),
        F.lit(minute_key(as_of)).alias("key_dt"),
        F.lit(1).cast("long").alias("click_count"),
        "received_revenue",
        F.col("offer_id").cast("string").alias("offer_id"),
        "paid_revenue",
        *(F.col(source).cast("string").alias(source) for source in DIMENSIONS.values()),
    )


def conversion_rejects(log: DataFrame) -> DataFrame:
    """Conversions that belong to no offer and are left out of the snapshots."""
    return log.filter(F.col("offer_id").isNull()).withColumn("reason", F.lit("no offer"))


def offer_totals(conversions: DataFrame, *by: str) -> DataFrame:
    """Rows, revenue and cost per ``by`` and offer. A missing amount adds nothing."""
    return (
        conversions.filter(F.col("offer_id").isNotNull())
        .groupBy(*by, "offer_id")
        .agg(
            F.count("*").alias("click_count"),
            F.coalesce(F.sum("received_revenue"), F.lit(0)).alias("received"),
            F.coalesce(F.sum("paid_revenue"), F.lit(0)).alias("paid"),
        )
    )


def joined_set(values: Column) -> Column:
    """The distinct values of a group in order, as one text; empty where there is none."""
    return F.array_join(F.array_sort(F.collect_set(values)), SEPARATOR)


def _dimension_columns() -> dict[str, Column]:
    """The values of a conversion that a snapshot lists, null where there is nothing to list."""
    return {
        name: F.nullif(F.col(column).cast("string"), F.lit(""))
        for name, column in DIMENSIONS.items()
    }


def dimension_values(conversions: DataFrame, *by: str) -> DataFrame:
    """The distinct affiliates, countries and zones per ``by`` and offer, one row each.

    The sets of :func:`offer_statistics` are texts and have to fit one row; here an offer may
    have any number of values, and no group is collected.
    """
    values = F.array(
        *(
            F.struct(F.lit(name).alias("dimension"), column.alias("value"))
            for name, column in _dimension_columns().items()
        )
    )
    rows = conversions.filter(F.col("offer_id").isNotNull()).select(
        *by, "offer_id", F.inline(values)
    )
    return rows.filter(F.col("value").isNotNull()).distinct()


def dimension_sets(conversions: DataFrame, *by: str) -> DataFrame:
    """The distinct values of the dimensions per ``by`` and offer as texts, without totals.

    They are lists of the rows of :func:`dimension_values`, which spread a hot offer by its values.
    A set of them would let the optimizer drop the distinct below it, and with it the spreading.
    """
    listed = {
        name: F.collect_list(F.when(F.col("dimension") == name, F.col("value")))
        for name in DIMENSIONS
    }
    none = F.lit(None).cast("string")
    every = conversions.filter(F.col("offer_id").isNotNull()).select(
        *by, "offer_id", none.alias("dimension"), none.alias("value")
    )
    return (
        dimension_values(conversions, *by)
        .unionByName(every.distinct())
        .groupBy(*by, "offer_id")
        .agg(
            *(
                F.array_join(F.array_sort(values), SEPARATOR).alias(name)
                for name, values in listed.items()
            )
        )
    )


def combination_totals(conversions: DataFrame, *by: str) -> DataFrame:
    """Totals per ``by``, offer and combination of affiliate, country and zone.

    This is the first of two aggregations. It is a hash aggregation with a partial step, and it
    spreads the rows of a hot offer over all tasks.
    """
    rows = conversions.select(
        *by,
        "offer_id",
        "received_revenue",
        "paid_revenue",
        *(column.alias(name) for name, column in _dimension_columns().items()),
    )
    return offer_totals(rows, *by, *DIMENSIONS)


def merge_combinations(combinations: DataFrame, *by: str) -> DataFrame:
    """Totals per ``by`` and offer, with the distinct affiliates, countries and zones.

    A combination comes in once, or once for each layer of totals, so no task meets a value as often as
    the log holds it.
    """
    return combinations.groupBy(*by, "offer_id").agg(
        F.sum("click_count").alias("click_count"),
        F.sum("received").alias("received"),
        F.sum("paid").alias("paid"),
        *(joined_set(F.col(name)).alias(name) for name in DIMENSIONS),
    )


def offer_statistics(conversions: DataFrame, *by: str) -> DataFrame:
    """Totals and distinct values per ``by`` and offer."""
    return merge_combinations(combination_totals(conversions, *by), *by)


def by_type(log: DataFrame, marks: dict[str, Column]) -> DataFrame:
    """The log once for each type, with the ``mark`` of the type where it has one.

    ``marks`` gives, by type, the period a conversion belongs to, or null for none.
    """
    types = F.array(
        *(
            F.struct(F.lit(key_type).alias("key_type"), mark.alias("mark"))
            for key_type, mark in marks.items()
        )
    )
    return log.select("*", F.inline(types)).filter(F.col("mark").isNotNull())


def by_marked_type(combinations: DataFrame, *types: str) -> DataFrame:
    """Combinations once for each type, with the ``mark`` in the column of the type where they have one."""
    return by_type(combinations, {key_type: F.col(key_type) for key_type in types})


def clock_statistics(log: DataFrame, marks: dict[str, Column]) -> DataFrame:
    """Statistics per offer, type and ``mark``, for all types in one scan.

    ``marks`` gives, by type, the period a conversion belongs to, or null for none. A
    combination is totalled over all marks at once and takes one row per type only then.
    """
    marked = log.select("*", *(mark.alias(key_type) for key_type, mark in marks.items()))
    rows = by_marked_type(combination_totals(marked, *marks), *marks)
    return merge_combinations(rows, "key_type", "mark")


def as_measures(received: str = "received", paid: str = "paid") -> list[Column]:
    """Revenue, cost and their difference, subtracted exactly and shown as doubles."""
    return [
        F.col(received).cast("double").alias("received_revenue"),
        F.col(paid).cast("double").alias("paid_revenue"),
        (F.col(received) - F.col(paid)).cast("double").alias("roi"),
    ]


def as_conversion_snapshot(statistics: DataFrame, key_dt: Column) -> DataFrame:
    return statistics.select(
        key_dt.alias("key_dt"),
        "key_type",
        F.col("offer_id").cast("string").alias("offerid"),
        *as_measures(),
        "click_count",
        *DIMENSIONS,
    ).select(*CONVERSION_SNAPSHOT.columns)


def conversion_snapshot(
    log: DataFrame, as_of: datetime, since: datetime | None = None
) -> DataFrame:
    """Statistics of the day so far on both clocks, stamped with the batch time.

    The windows are tested twice: for either of them on the log, where the test can be pushed
    to the scan, and for each. ``since`` opens them earlier than the start of the day.
    """
    seen = log.filter(in_either_window(log, as_of, since))
    statistics = clock_statistics(seen, window_marks(log, as_of, since))
    return as_conversion_snapshot(statistics, F.lit(minute_key(as_of)))


def window_marks(
    log: DataFrame, as_of: datetime, since: datetime | None = None
) -> dict[str, Column]:
    """By type, whether a conversion is in the window of the type, or null."""
    return {
        key_type: F.when(in_window(log, clock, as_of, since), True)
        for key_type, clock in CLOCKS.items()
    }


def _utc_day(log: DataFrame, clock: str) -> Column:
    """The day of a clock in UTC, whatever the time zone of the session."""
    time = F.col(clock)
    if isinstance(log.schema[clock].dataType, T.TimestampType):
        time = F.to_utc_timestamp(time, F.current_timezone())
    return F.to_date(time)


def conversion_snapshots_by_day(log: DataFrame) -> DataFrame:
    """The snapshots that runs at the very end of every day would give."""
    days = {key_type: _utc_day(log, clock) for key_type, clock in CLOCKS.items()}
    last_minute = F.concat(F.col("mark").cast("string"), F.lit(" 23:59"))
    return as_conversion_snapshot(clock_statistics(log, days), last_minute)

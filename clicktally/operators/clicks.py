"""Clicks: parsing, rejects, counting and searching."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktally.functions import minute_key
from clicktally.schemas import CLICK, CLICK_SNAPSHOT

TAB = "\t"

# Token positions of a click line, the shortest counted key (offer and
# advertiser with one separator) and the subid of a merged group.
TOKENS = {
    "key_type": 0,
    "offer_id": 6,
    "offer_advertiser_id": 5,
    "destination_subid": 2,
}
SHORTEST_KEY = 4
MERGED_SUBID = "NA"

PARTIAL_COLUMNS = ["clicks", "lowest_type", "lowest_subid"]


def _is_complete(line: Column) -> Column:
    """Whether a line has all tokens up to the last one needed, without splitting it."""
    return F.substring_index(line, TAB, max(TOKENS.values())) != line


def parse_clicks(lines: DataFrame) -> DataFrame:
    """Clicks of the complete lines; columns besides ``value`` are kept."""
    tokens = F.split("value", TAB)
    others = [name for name in lines.columns if name != "value"]
    return lines.filter(_is_complete(F.col("value"))).select(
        *others, *(F.get(tokens, F.lit(TOKENS[name])).alias(name) for name in CLICK.names)
    )


def click_rejects(lines: DataFrame) -> DataFrame:
    """Lines that :func:`parse_clicks` leaves out, with the reason."""
    complete = F.coalesce(_is_complete(F.col("value")), F.lit(False))
    return lines.filter(~complete).select(
        "*",
        F.when(F.col("value").isNull(), "no line")
        .otherwise("fewer than 7 tokens")
        .alias("reason"),
    )


def keep_long_keys(clicks: DataFrame) -> DataFrame:
    """Clicks whose offer and advertiser together are long enough to be counted."""
    key_length = F.length("offer_id") + F.length("offer_advertiser_id") + 1
    return clicks.filter(key_length >= SHORTEST_KEY)


def partial_counts(clicks: DataFrame, *by: str) -> DataFrame:
    """Counts per ``by``, offer and advertiser, in a form that can be merged again."""
    return (
        keep_long_keys(clicks)
        .groupBy(*by, "offer_id", "offer_advertiser_id")
        .agg(
            F.count("*").alias("clicks"),
            F.min("key_type").alias("lowest_type"),
            F.min("destination_subid").alias("lowest_subid"),
        )
    )


def merge_counts(partials: DataFrame, *by: str) -> DataFrame:
    """One row per ``by``, offer and advertiser from several partial counts."""
    return partials.groupBy(*by, "offer_id", "offer_advertiser_id").agg(
        F.sum("clicks").alias("clicks"),
        F.min("lowest_type").alias("lowest_type"),
        F.min("lowest_subid").alias("lowest_subid"),
    )


def as_click_snapshot(counts: DataFrame, key_dt: Column) -> DataFrame:
    """Snapshot rows of merged counts. Only a group of one click keeps its subid."""
    return counts.select(
        key_dt.alias("key_dt"),
        F.col("lowest_type").alias("key_type"),
        "offer_id",
        "offer_advertiser_id",
        F.when(F.col("clicks") > 1, MERGED_SUBID)
        .otherwise(F.col("lowest_subid"))
        .alias("destination_subid"),
        F.col("clicks").alias("count_of_clicks"),
    ).select(*CLICK_SNAPSHOT.columns)


def click_counts(clicks: DataFrame, as_of: datetime) -> DataFrame:
    """Clicks per offer and advertiser, stamped with the batch time.

    ``clicks`` are those of the hour so far, so a later snapshot of the same hour holds more
    and the first of the next hour starts anew. The type of a group is its smallest.
    """
    return as_click_snapshot(partial_counts(clicks), F.lit(minute_key(as_of)))


def hour_end_key(hour: Column) -> Column:
    """The key of a run in the last minute of an hour given as ``yyyy/MM/dd/HH``."""
    return F.concat(
        F.translate(F.substring(hour, 1, 10), "/", "-"),
        F.lit(" "),
        F.substring(hour, 12, 2),
        F.lit(":59"),
    )


def click_counts_by_hour(clicks: DataFrame) -> DataFrame:
    """The snapshots that runs at the very end of every ``hour`` would give, in one pass."""
    return as_click_snapshot(partial_counts(clicks, "hour"), hour_end_key(F.col("hour")))


def search_clicks(clicks: DataFrame, destination_subid: str) -> DataFrame:
    """Offer and advertiser of every click with the given subid, repeated clicks included."""
    return clicks.filter(F.col("destination_subid") == destination_subid).select(
        "offer_id", "offer_advertiser_id"
    )

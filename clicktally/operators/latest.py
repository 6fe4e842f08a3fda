"""The latest snapshot of each day."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktally.functions import day_key, day_of_key, parsed_key
from clicktally.schemas import CLICK_DAILY, CONVERSION_DAILY


def since_today(snapshots: DataFrame, as_of: datetime) -> DataFrame:
    """Snapshots since the start of the day of ``as_of``, by text and without an upper end."""
    return snapshots.filter(F.col("key_dt") >= day_key(as_of))


def _reject_reason(offer: str) -> Column:
    return (
        F.when(F.col(offer).isNull(), "no offer")
        .when(parsed_key(F.col("key_dt")).isNull(), "key_dt is not a minute")
        .when(F.col("key_type").isNull(), "no type")
    )


def snapshot_rejects(snapshots: DataFrame, offer: str) -> DataFrame:
    """Snapshots that cannot be consolidated, with the reason."""
    return snapshots.withColumn("reason", _reject_reason(offer)).filter(
        F.col("reason").isNotNull()
    )


def _latest(
    snapshots: DataFrame, by: list[str], columns: list[str], also: tuple[str, ...] = ()
) -> DataFrame:
    """Per day and ``by``, the row with the latest key; the tie goes to the greatest others.

    The largest struct of all columns is that row, since minute keys sort as text like the
    times they name. Equal input gives equal output however it is partitioned, and a partial
    aggregation leaves one row per group and task before the shuffle. ``also`` are columns that the
    day determines, such as the time of a watermark.
    """
    kept = [name for name in columns if name not in ("key_dt", *by)]
    row = F.struct(F.col("key_dt").alias("minute"), *kept)
    return (
        snapshots.filter(_reject_reason(by[-1]).isNull())
        .groupBy(day_of_key(F.col("key_dt")).alias("key_dt"), *also, *by)
        .agg(F.max(row).alias("latest"))
        .select("key_dt", *by, *(f"latest.{name}" for name in kept))
        .select(*columns)
    )


def latest_clicks(snapshots: DataFrame, *also: str) -> DataFrame:
    """The latest click snapshot per day and offer.

    Neither type nor advertiser is in the group, and a snapshot counts its hour only: the
    result is the count of the last hour in which the offer was seen, not the total of the day.
    """
    return _latest(snapshots, ["offer_id"], CLICK_DAILY.columns, also)


def latest_conversions(snapshots: DataFrame, *also: str) -> DataFrame:
    """The latest conversion snapshot per day, type and offer: the total of the day."""
    return _latest(snapshots, ["key_type", "offerid"], CONVERSION_DAILY.columns, also)

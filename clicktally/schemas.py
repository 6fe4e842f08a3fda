"""Schemas and contracts of the tables that the jobs read and write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(18, 4)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# A parsed click line.
CLICK = _struct(
    key_type=StringType(),
    offer_id=StringType(),
    offer_advertiser_id=StringType(),
    destination_subid=StringType(),
)

# The warehouse table of conversions, as far as the jobs read it.
CONVERSION_LOG = _struct(
    received_revenue=MONEY,
    offer_id=StringType(),
    paid_revenue=MONEY,
    affiliate_id=StringType(),
    geo_country=StringType(),
    subid4=StringType(),
    conversion_time=TimestampType(),
    redshift_time=TimestampType(),
)


@dataclass(frozen=True)
class TableContract:
    """Columns, primary key and text widths of a result table."""

    name: str
    schema: StructType
    key: tuple[str, ...]
    widths: dict[str, int]

    @property
    def columns(self) -> list[str]:
        return self.schema.names


_CLICK_COLUMNS = _struct(
    key_dt=StringType(),
    key_type=StringType(),
    offer_id=StringType(),
    offer_advertiser_id=StringType(),
    destination_subid=StringType(),
    count_of_clicks=LongType(),
)

_MEASURES = {
    "received_revenue": DoubleType(),
    "paid_revenue": DoubleType(),
    "roi": DoubleType(),
    "click_count": LongType(),
}

# Table names, columns, keys and widths of the four result tables. The key of
# the click snapshots has the advertiser added, because the job counts per advertiser, and
# their subid is as wide as in the daily table, because ids of 36 characters occur.
CLICK_SNAPSHOT = TableContract(
    name="v2_s3_stats",
    schema=_CLICK_COLUMNS,
    key=("key_dt", "key_type", "offer_id", "offer_advertiser_id"),
    widths={
        "key_dt": 20,
        "key_type": 20,
        "offer_id": 30,
        "offer_advertiser_id": 30,
        "destination_subid": 100,
    },
)

CONVERSION_SNAPSHOT = TableContract(
    name="v2_agg_stats",
    schema=_struct(
        key_dt=StringType(),
        key_type=StringType(),
        offerid=StringType(),
        **_MEASURES,
        affiliates=StringType(),
        geo=StringType(),
        zones=StringType(),
    ),
    key=("key_dt", "key_type", "offerid"),
    widths={
        "key_dt": 20,
        "key_type": 2,
        "offerid": 30,
        "affiliates": 500,
        "geo": 500,
        "zones": 500,
    },
)

CLICK_DAILY = TableContract(
    name="v2_s3_consolidate_stats",
    schema=_CLICK_COLUMNS,
    key=("key_dt", "key_type", "offer_id"),
    widths={
        "key_dt": 20,
        "key_type": 20,
        "offer_id": 30,
        "offer_advertiser_id": 100,
        "destination_subid": 100,
    },
)

CONVERSION_DAILY = TableContract(
    name="v2_agg_consolidate_stats",
    schema=_struct(
        key_dt=StringType(), key_type=StringType(), offerid=StringType(), **_MEASURES
    ),
    key=("key_dt", "key_type", "offerid"),
    widths={"key_dt": 20, "key_type": 20, "offerid": 30},
)

# Columns that an upsert into the daily tables changes on rows that are already there.
CLICK_UPDATES = ("count_of_clicks",)
CONVERSION_UPDATES = tuple(_MEASURES)

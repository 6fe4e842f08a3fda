import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clicktally.operators.conversions import (
    conversion_rejects,
    conversion_snapshot,
    conversion_snapshots_by_day,
    conversions_in_window,
    dimension_values,
    offer_totals,
    tag_conversions,
)
from clicktally.schemas import CONVERSION_LOG, CONVERSION_SNAPSHOT
from clicktally.sources import conversion_predicates

AS_OF = datetime(2024, 1, 5, 12)
NTZ_LOG = "received_revenue decimal(18,4), offer_id string, paid_revenue decimal(18,4)," + (
    " affiliate_id string, geo_country string, subid4 string,"
    " conversion_time timestamp_ntz, redshift_time timestamp_ntz"
)


def conversion(offer, received, paid, affiliate, geo, zone, happened, loaded):
    def money(value):
        return None if value is None else Decimal(value)

    def time(value):
        return None if value is None else datetime.fromisoformat(value)

    return (
        money(received), offer, money(paid), affiliate, geo, zone, time(happened), time(loaded),
    )


GOLDEN = [
    conversion("7", "10.00", "4.00", "a1", "US", "z1", "2024-01-05T00:00:00", "2024-01-05T00:10:00"),
    conversion("7", "5.50", "1.00", "a2", "US", "", "2024-01-05T12:00:00", "2024-01-05T12:00:01"),
    conversion("7", "1.00", "1.00", "a1", "DE", "z2", "2024-01-04T23:59:59", "2024-01-05T01:00:00"),
]


def log_of(spark, rows, schema=NTZ_LOG):
    return spark.createDataFrame(rows, schema)


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_statistics_on_both_clocks(spark):
    snapshot = conversion_snapshot(log_of(spark, GOLDEN), AS_OF)
    assert snapshot.columns == CONVERSION_SNAPSHOT.columns
    assert rows(snapshot) == [
        ("2024-01-05 12:00", "C", "7", 15.5, 5.0, 10.5, 2, "a1#a2", "US", "z1"),
        ("2024-01-05 12:00", "R", "7", 11.0, 5.0, 6.0, 2, "a1", "DE#US", "z1#z2"),
    ]


def test_zoned_times_give_the_same(spark):
    ntz = log_of(spark, GOLDEN)
    zoned = ntz.select(
        *(F.col(field.name).cast(field.dataType).alias(field.name) for field in CONVERSION_LOG)
    )
    assert rows(conversion_snapshot(zoned, AS_OF)) == rows(conversion_snapshot(ntz, AS_OF))


def test_one_pass_equals_two(spark):
    log = log_of(spark, GOLDEN * 3).repartition(4)
    at_once = conversion_snapshot(log, AS_OF)
    for key_type, clock in (("C", "conversion_time"), ("R", "redshift_time")):
        alone = tag_conversions(conversions_in_window(log, clock, AS_OF), key_type, AS_OF)
        assert {row.key_dt for row in alone.collect()} == {"2024-01-05 12:00"}
        totals = rows(offer_totals(alone))
        found = at_once.filter(F.col("key_type") == key_type).collect()
        assert [(r.offerid, r.click_count, r.received_revenue, r.paid_revenue) for r in found] == [
            (offer, count, float(received), float(paid)) for offer, count, received, paid in totals
        ]


def test_missing_values(spark):
    log = log_of(
        spark,
        [
            conversion("1", None, "2", None, None, "", "2024-01-05T01:00:00", None),
            conversion("1", "3", None, "a", "US", None, "2024-01-05T02:00:00", None),
            conversion("2", None, None, None, None, None, "2024-01-05T02:00:00", None),
            conversion(None, "9", "9", "a", "US", "z", "2024-01-05T02:00:00", None),
        ],
    )
    assert rows(conversion_snapshot(log, AS_OF)) == [
        ("2024-01-05 12:00", "C", "1", 3.0, 2.0, 1.0, 2, "a", "US", ""),
        ("2024-01-05 12:00", "C", "2", 0.0, 0.0, 0.0, 1, "", "", ""),
    ]
    assert [(r.received_revenue, r.reason) for r in conversion_rejects(log).collect()] == [
        (Decimal("9.0000"), "no offer")
    ]


def test_days_equal_one_run_per_day(spark):
    draw = random.Random(5)
    log = log_of(
        spark,
        [
            conversion(
                str(draw.randrange(4)), str(draw.randrange(100)), "1", f"a{draw.randrange(5)}",
                draw.choice(["US", "DE"]), draw.choice(["", "z1", "z2"]),
                f"2024-01-0{draw.randrange(1, 5)}T{draw.randrange(24):02d}:30:00",
                f"2024-01-0{draw.randrange(3, 7)}T{draw.randrange(24):02d}:30:00",
            )
            for _ in range(300)
        ],
    )
    runs = [
        row
        for day in range(1, 8)
        for row in rows(conversion_snapshot(log, datetime(2024, 1, day, 23, 59)))
    ]
    assert rows(conversion_snapshots_by_day(log)) == sorted(runs)


def test_a_hot_offer_is_counted_whole(spark):
    hot = spark.range(20_000).select(
        F.lit(1).cast("decimal(18,4)").alias("received_revenue"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("offer_id"),
        F.lit(0).cast("decimal(18,4)").alias("paid_revenue"),
        (F.col("id") % 50).cast("string").alias("affiliate_id"),
        F.lit("US").alias("geo_country"),
        F.col("id").cast("string").alias("subid4"),
        F.lit(datetime(2024, 1, 5)).cast("timestamp_ntz").alias("conversion_time"),
        F.lit(None).cast("timestamp_ntz").alias("redshift_time"),
    )
    row = conversion_snapshots_by_day(hot).filter(F.col("offerid") == "hot").first()
    expected = [i for i in range(20_000) if i % 3]
    assert row.click_count == len(expected)
    assert row.zones.split("#") == sorted(str(i) for i in expected)
    assert row.affiliates.split("#") == sorted(str(i) for i in range(50))
    values = dimension_values(hot).filter(F.col("offer_id") == "hot").groupBy("dimension").count()
    assert rows(values) == [("affiliates", 50), ("geo", 1), ("zones", len(expected))]


@pytest.mark.parametrize("slices", [1, 7, 24])
def test_database_slices_hold_each_row_of_the_window_once(spark, slices):
    draw = random.Random(slices)

    def moment():
        day, hour, second = draw.randrange(4, 7), draw.choice([0, 11, 12, 23]), draw.randrange(2)
        return draw.choice([None, datetime(2024, 1, day, hour, 0, second)])

    pairs = [(i, moment(), moment()) for i in range(400)]
    log = spark.createDataFrame(
        pairs, "id int, conversion_time timestamp_ntz, redshift_time timestamp_ntz"
    )
    found = [
        row.id
        for predicate in conversion_predicates(AS_OF, slices=slices)
        for row in log.filter(predicate.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")).collect()
    ]
    start = datetime.combine(date(2024, 1, 5), datetime.min.time())
    wanted = [
        i
        for i, *times in pairs
        if any(time is not None and start <= time <= AS_OF for time in times)
    ]
    assert sorted(found) == wanted

import random
from datetime import datetime

from pyspark.sql import functions as F

from clicktally.operators.latest import (
    latest_clicks,
    latest_conversions,
    since_today,
    snapshot_rejects,
)
from clicktally.operators.upsert import upsert
from clicktally.schemas import (
    CLICK_DAILY,
    CLICK_SNAPSHOT,
    CLICK_UPDATES,
    CONVERSION_DAILY,
    CONVERSION_UPDATES,
)
from clicktally.sources import snapshot_predicates

AS_OF = datetime(2024, 1, 5, 13)
SNAPSHOTS = [
    ("2024-01-04 23:55", "C", "o1", 99),
    ("2024-01-05 09:55", "C", "o1", 40),
    ("2024-01-05 10:05", "R", "o1", 3),
    ("2024-01-05 10:00", "C", "o2", 8),
]


def clicks(spark, rows):
    return spark.createDataFrame(
        [(key, kind, offer, "adv", "s", count) for key, kind, offer, count in rows],
        CLICK_SNAPSHOT.schema,
    )


def conversions(spark, rows):
    return spark.createDataFrame(
        [(key, kind, offer, 1.0, 1.0, 0.0, count) for key, kind, offer, count in rows],
        CONVERSION_DAILY.schema,
    )


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def test_latest_clicks_ignore_type(spark):
    latest = latest_clicks(since_today(clicks(spark, SNAPSHOTS), AS_OF))
    assert rows(latest) == [
        ("2024-01-05", "C", "o2", "adv", "s", 8),
        ("2024-01-05", "R", "o1", "adv", "s", 3),
    ]


def test_latest_conversions_per_type(spark):
    latest = latest_conversions(since_today(conversions(spark, SNAPSHOTS), AS_OF))
    assert [(r[0], r[1], r[2], r[6]) for r in rows(latest)] == [
        ("2024-01-05", "C", "o1", 40),
        ("2024-01-05", "C", "o2", 8),
        ("2024-01-05", "R", "o1", 3),
    ]


def test_latest_does_not_depend_on_order(spark):
    draw = random.Random(3)
    snapshots = [
        (f"2024-01-05 1{draw.randrange(2)}:0{draw.randrange(3)}", draw.choice("CR"),
         f"o{draw.randrange(5)}", draw.randrange(50))
        for _ in range(200)
    ]
    expected = {}
    for key, kind, offer, count in snapshots:
        expected[offer] = max(expected.get(offer, ("",)), (key, kind, count))
    for parts in (1, 6):
        draw.shuffle(snapshots)
        latest = latest_clicks(clicks(spark, snapshots).repartition(parts))
        assert {(r[2]): (r[1], r[5]) for r in rows(latest)} == {
            offer: (kind, count) for offer, (_, kind, count) in expected.items()
        }


def test_spoilt_snapshots_are_set_aside(spark):
    snapshots = clicks(
        spark,
        [*SNAPSHOTS, ("2024-01-05", "C", "o1", 7), ("2024-01-05 25:00", "C", "o9", 7),
         ("2024-01-05 11:00", "C", None, 7), (None, "C", "o1", 7)],
    )
    assert rows(latest_clicks(snapshots)) == rows(latest_clicks(clicks(spark, SNAPSHOTS)))
    rejected = snapshot_rejects(snapshots, "offer_id").select("key_dt", "offer_id", "reason")
    assert rows(rejected) == [
        ("2024-01-05 11:00", None, "no offer"),
        ("2024-01-05 25:00", "o9", "key_dt is not a minute"),
        ("2024-01-05", "o1", "key_dt is not a minute"),
        (None, "o1", "key_dt is not a minute"),
    ]


TARGET = [
    ("2024-01-05", "C", "o1", "advA", "s1", 5),
    ("2024-01-05", "C", "o2", "advA", "s2", 6),
]
UPDATES = [
    ("2024-01-05", "C", "o1", "advB", "NA", 9),
    ("2024-01-05", "R", "o1", "advB", "NA", 1),
]


def test_upsert_changes_the_count_only(spark):
    target = spark.createDataFrame(TARGET, CLICK_DAILY.schema)
    updates = spark.createDataFrame(UPDATES, CLICK_DAILY.schema)
    once = upsert(target, updates, CLICK_DAILY.key, CLICK_UPDATES)
    assert once.columns == CLICK_DAILY.columns
    assert rows(once) == [
        ("2024-01-05", "C", "o1", "advA", "s1", 9),
        ("2024-01-05", "C", "o2", "advA", "s2", 6),
        ("2024-01-05", "R", "o1", "advB", "NA", 1),
    ]
    assert rows(upsert(once, updates, CLICK_DAILY.key, CLICK_UPDATES)) == rows(once)


def test_upsert_of_conversions_takes_all_measures_and_nulls(spark):
    target = spark.createDataFrame(
        [("2024-01-05", "C", "o1", 1.0, 1.0, 0.0, 1), ("2024-01-05", "C", "o2", 2.0, 1.0, 1.0, 2)],
        CONVERSION_DAILY.schema,
    )
    updates = spark.createDataFrame(
        [("2024-01-05", "C", "o1", None, 4.0, None, 7)], CONVERSION_DAILY.schema
    )
    merged = upsert(target, updates, CONVERSION_DAILY.key, CONVERSION_UPDATES)
    assert rows(merged) == [
        ("2024-01-05", "C", "o1", None, 4.0, None, 7),
        ("2024-01-05", "C", "o2", 2.0, 1.0, 1.0, 2),
    ]


def test_database_slices_hold_each_snapshot_since_today_once(spark):
    keys = [f"2024-01-0{day} {hour:02d}:{minute}" for day in (4, 5, 6) for hour in range(24)
            for minute in ("00", "59")] + ["2024-01-05", "2024-01-04"]
    frame = spark.createDataFrame([(key,) for key in keys], "key_dt string")
    found = [
        row.key_dt
        for predicate in snapshot_predicates(AS_OF)
        for row in frame.filter(F.expr(predicate)).collect()
    ]
    assert sorted(found) == sorted(key for key in keys if key >= "2024-01-05")

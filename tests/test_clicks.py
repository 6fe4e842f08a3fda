import gzip
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from clicktally.operators.checks import key_violations
from clicktally.operators.clicks import (
    click_counts,
    click_counts_by_hour,
    click_rejects,
    merge_counts,
    parse_clicks,
    partial_counts,
    search_clicks,
)
from clicktally.schemas import CLICK_DAILY, CLICK_SNAPSHOT
from clicktally.sources import ClickLayout, read_click_lines

AS_OF = datetime(2024, 1, 5, 10, 35)


def line(kind, subid, advertiser, offer, *more):
    return "\t".join([kind, "x", subid, "x", "", advertiser, offer, *more])


LINES = [
    line("C", "s1", "adv1", "off1"),
    line("C", "s2", "adv1", "off1"),
    line("C", "s3", "adv2", "off1"),
    line("C", "s4", "2", "1"),
    line("C", "s5", "2", "10"),
    "C\tx",
]

COUNTS = [
    ("2024-01-05 10:35", "C", "10", "2", "s5", 1),
    ("2024-01-05 10:35", "C", "off1", "adv1", "NA", 2),
    ("2024-01-05 10:35", "C", "off1", "adv2", "s3", 1),
]


def lines_of(spark, values):
    return spark.createDataFrame([(value,) for value in values], "value string")


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_counts_per_offer_and_advertiser(spark):
    clicks = parse_clicks(lines_of(spark, LINES))
    counts = click_counts(clicks, AS_OF)
    assert counts.columns == CLICK_SNAPSHOT.columns
    assert rows(counts) == COUNTS


def test_offer_with_two_advertisers_breaks_the_narrow_key_only(spark):
    counts = click_counts(parse_clicks(lines_of(spark, LINES)), AS_OF)
    assert rows(key_violations(counts, CLICK_DAILY.key)) == [
        ("2024-01-05 10:35", "C", "off1", 2, "repeated key")
    ]
    assert rows(key_violations(counts, CLICK_SNAPSHOT.key)) == []


@pytest.mark.parametrize(
    "value, complete",
    [
        ("", False),
        ("a\tb\tc\td\te\tf", False),
        ("a\tb\tc\td\te\tf\tg", True),
        ("\t\t\t\t\t\t", True),
        ("\t\t\t\t\t", False),
        ('"C\tx\ts\tx\tx\ta\to\t\t\t', True),
    ],
)
def test_a_line_is_either_parsed_or_rejected(spark, value, complete):
    lines = lines_of(spark, [value])
    parsed, rejected = parse_clicks(lines).collect(), click_rejects(lines).collect()
    assert (len(parsed), len(rejected)) == ((1, 0) if complete else (0, 1))
    if complete:
        tokens = value.split("\t")
        assert tuple(parsed[0]) == (tokens[0], tokens[6], tokens[5], tokens[2])
    else:
        assert tuple(rejected[0]) == (value, "fewer than 7 tokens")


def test_no_two_pairs_share_a_group(spark):
    clicks = parse_clicks(
        lines_of(spark, [line("C", "s1", "c", "a_b"), line("C", "s2", "b_c", "a")])
    )
    assert [row[5] for row in rows(click_counts(clicks, AS_OF))] == [1, 1]


def test_type_of_a_group_is_the_smallest_in_any_order(spark):
    values = [line(kind, "s", "adv", "off") for kind in "RCX"]
    for _ in range(3):
        random.shuffle(values)
        clicks = parse_clicks(lines_of(spark, values).repartition(3))
        assert rows(click_counts(clicks, AS_OF)) == [
            ("2024-01-05 10:35", "C", "off", "adv", "NA", 3)
        ]


def test_counts_add_up_to_the_clicks_with_long_keys(spark):
    draw = random.Random(7)
    values = [
        line("C", f"s{i}", str(draw.randrange(12)), str(draw.randrange(12)))
        for i in range(500)
    ]
    clicks = parse_clicks(lines_of(spark, values).repartition(5))
    expected = {}
    for value in values:
        tokens = value.split("\t")
        if len(tokens[5]) + len(tokens[6]) >= 3:
            expected.setdefault((tokens[6], tokens[5]), []).append(tokens[2])
    found = {(r[2], r[3]): (r[4], r[5]) for r in rows(click_counts(clicks, AS_OF))}
    assert found == {
        key: (subids[0] if len(subids) == 1 else "NA", len(subids))
        for key, subids in expected.items()
    }


def test_a_hot_pair_is_counted_whole(spark):
    hot = spark.range(30_000).select(
        F.lit("C").alias("key_type"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("offer_id"),
        F.lit("adv").alias("offer_advertiser_id"),
        F.col("id").cast("string").alias("destination_subid"),
    )
    counts = {row[2]: (row[4], row[5]) for row in click_counts(hot, AS_OF).collect()}
    assert counts.pop("hot") == ("NA", 10_000)
    assert counts == {str(i): (str(i), 1) for i in range(30_000) if i % 3}


def test_partial_counts_merge_to_the_whole(spark):
    clicks = parse_clicks(lines_of(spark, LINES * 3)).withColumn("hour", F.lit("2024/01/05/10"))
    halves = partial_counts(clicks, "hour").unionByName(partial_counts(clicks, "hour"))
    whole = partial_counts(clicks.unionByName(clicks), "hour")
    assert rows(merge_counts(halves, "hour")) == rows(whole)


def test_hours_are_counted_apart(spark):
    clicks = lines_of(spark, LINES[:2]).withColumn(
        "hour", F.when(F.col("value").contains("s1"), "2024/01/05/10").otherwise("2024/01/05/11")
    )
    assert rows(click_counts_by_hour(parse_clicks(clicks))) == [
        ("2024-01-05 10:59", "C", "off1", "adv1", "s1", 1),
        ("2024-01-05 11:59", "C", "off1", "adv1", "s2", 1),
    ]


def test_search_keeps_repeated_clicks(spark):
    clicks = parse_clicks(lines_of(spark, [*LINES, LINES[1]]))
    assert rows(search_clicks(clicks, "s2")) == [("off1", "adv1")] * 2
    assert rows(search_clicks(clicks, "none")) == []


def put(root, folder, name, values):
    path = root / folder
    path.mkdir(parents=True, exist_ok=True)
    with gzip.open(path / name, "wt") as file:
        file.writelines(value + "\n" for value in values)


@pytest.fixture
def layout(tmp_path):
    """Two hours of an odd day and one of the even day after, and files no run may read."""
    put(tmp_path, "offer-stream-even/2024/01/05/10", "a.gz", LINES[:2])
    put(tmp_path, "offer-stream-even/2024/01/05/10", "b.gz", LINES[2:])
    put(tmp_path, "offer-stream-even/2024/01/05/11", "a.gz", LINES[:1])
    put(tmp_path, "offer-stream-odd/2024/01/06/00", "a.gz", LINES[1:2])
    put(tmp_path, "offer-stream-odd/2024/01/05/10", "a.gz", LINES[:1])
    put(tmp_path, "offer-stream-even/2024/01/06/00", "a.gz", LINES[:1])
    put(tmp_path, "offer-stream-even/2024/01/05/10", "notes.txt", LINES[:1])
    return ClickLayout(str(tmp_path))


def test_globs_follow_hour_day_and_stream():
    layout = ClickLayout("s3a://b/c")
    assert layout.hour_glob(AS_OF) == "s3a://b/c/offer-stream-even/2024/01/05/10/*.gz"
    assert layout.day_glob(AS_OF) == "s3a://b/c/offer-stream-even/2024/01/05/*/*.gz"
    even = datetime(2024, 1, 6, 3)
    assert layout.hour_glob(even) == "s3a://b/c/offer-stream-odd/2024/01/06/03/*.gz"
    zoned = datetime.fromisoformat("2024-01-06T01:00:00+02:00")
    assert layout.hour_glob(zoned) == "s3a://b/c/offer-stream-even/2024/01/05/23/*.gz"
    assert zoned.tzinfo is not timezone.utc


def test_range_glob_names_whole_days_once():
    glob = ClickLayout("r").range_glob(datetime(2024, 1, 5, 22), datetime(2024, 1, 7, 1))
    assert glob == (
        "r/{offer-stream-even/2024/01/05/22,offer-stream-even/2024/01/05/23,"
        "offer-stream-odd/2024/01/06/*,"
        "offer-stream-even/2024/01/07/00,offer-stream-even/2024/01/07/01}/*.gz"
    )


def test_files_of_hour_day_and_range(spark, layout):
    def count(glob):
        lines = read_click_lines(spark, layout, glob)
        return sorted(tuple(row) for row in lines.groupBy("hour").count().collect())

    assert count(layout.hour_glob(AS_OF)) == [("2024/01/05/10", 6)]
    assert count(layout.day_glob(AS_OF)) == [("2024/01/05/10", 6), ("2024/01/05/11", 1)]
    whole = layout.range_glob(datetime(2024, 1, 4, 3), datetime(2024, 1, 6, 0))
    assert count(whole) == [
        ("2024/01/05/10", 6),
        ("2024/01/05/11", 1),
        ("2024/01/06/00", 1),
    ]


def test_missing_files_give_no_lines(spark, layout):
    lines = read_click_lines(spark, layout, layout.hour_glob(datetime(2023, 1, 1)))
    assert lines.columns == ["value", "hour"]
    assert rows(click_counts(parse_clicks(lines), AS_OF)) == []


def test_streams_can_be_swapped(spark, layout):
    swapped = ClickLayout(layout.root, "offer-stream-odd", "offer-stream-even")
    assert read_click_lines(spark, swapped, swapped.day_glob(AS_OF)).count() == 1

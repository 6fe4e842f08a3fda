"""Mergeable distinct counts: any split of the log, repeated runs, runs that die, a hot offer."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clicktally.operators import distinct_counts as operator
from clicktally.plans import distinct_values
from clicktally.plans.distinct_values import (
    add_conversions,
    merge_runs,
    offer_value_counts,
    read_bitmaps,
)
from tests.test_conversions import log_of

TIME = datetime(2024, 1, 5)


def conversions(rng, number):
    return [
        (
            "1.00",
            rng.choice([None, "o1", "o2", "o3"]),
            "1.00",
            rng.choice([None, "", *(f"a{i}" for i in range(40))]),
            rng.choice(["US", "DE", ""]),
            rng.choice([None, "z1"]),
        )
        for _ in range(number)
    ]


NAMES = ("received_revenue", "offer_id", "paid_revenue", "affiliate_id", "geo_country", "subid4")


def frame_of(spark, values):
    return spark.createDataFrame(values, ", ".join(f"{name} string" for name in NAMES))


def plain_counts(values):
    found = {}
    for value in values:
        row = dict(zip(NAMES, value, strict=True))
        for dimension, name in (("affiliates", "affiliate_id"), ("geo", "geo_country"), ("zones", "subid4")):
            if row["offer_id"] is not None and row[name]:
                found.setdefault((row["offer_id"], dimension), set()).add(row[name])
    return {key: len(held) for key, held in found.items()}


def counts_of(bitmaps):
    return {(r.offer_id, r.dimension): r.n_values for r in offer_value_counts(bitmaps).collect()}


@pytest.mark.parametrize("seed", range(2))
def test_any_split_gives_the_counts_of_the_whole(spark, tmp_path, seed):
    rng = random.Random(seed)
    values = conversions(rng, 150)
    store = str(tmp_path / "store")
    cuts = sorted(rng.randrange(150) for _ in range(2))
    for run, (begin, end) in enumerate(zip([0, *cuts], [*cuts, 150], strict=True)):
        add_conversions(frame_of(spark, values[begin:end]), store, f"r{run}")
        assert counts_of(read_bitmaps(spark, store)) == plain_counts(values[:end])
    # A repeated run changes nothing, and some runs give the counts of their part.
    add_conversions(frame_of(spark, values[: cuts[0]]), store, "r0")
    bitmaps = read_bitmaps(spark, store)
    assert counts_of(bitmaps) == plain_counts(values)
    assert counts_of(bitmaps.filter("run <> 'r0'")) == plain_counts(values[cuts[0] :])
    merged = str(tmp_path / "merged")
    merge_runs(spark, store, merged)
    assert counts_of(spark.read.parquet(merged)) == plain_counts(values)


def test_a_run_that_dies_after_numbering_changes_no_count(spark, tmp_path, monkeypatch):
    rng = random.Random(7)
    first, second = conversions(rng, 60), conversions(rng, 60)
    store = str(tmp_path / "store")
    add_conversions(frame_of(spark, first), store, "a")

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(distinct_values, "value_bitmaps", killed)
        with pytest.raises(RuntimeError, match="killed"):
            add_conversions(frame_of(spark, second), store, "b")
    assert counts_of(read_bitmaps(spark, store)) == plain_counts(first)
    add_conversions(frame_of(spark, second), store, "b")
    assert counts_of(read_bitmaps(spark, store)) == plain_counts(first + second)
    numbers = spark.read.parquet(f"{store}/numbers")
    assert numbers.select("number").distinct().count() == numbers.count()
    assert numbers.select("dimension", "value").distinct().count() == numbers.count()


def test_nothing_gives_no_counts(spark, tmp_path):
    store = str(tmp_path / "store")
    assert counts_of(read_bitmaps(spark, store)) == {}
    add_conversions(frame_of(spark, []), store, "a")
    assert counts_of(read_bitmaps(spark, store)) == {}


def test_a_hot_offer_is_merged_by_pieces(spark):
    rows = spark.range(200_000).select(
        F.lit("hot").alias("offer_id"), F.lit("affiliates").alias("dimension"),
        (F.col("id") % 100_000).cast("string").alias("value"),
    )
    numbers = spark.range(100_000).select(
        F.lit("affiliates").alias("dimension"),
        F.col("id").cast("string").alias("value"),
        (F.col("id") + 1).alias("number"),
    )
    bitmaps = operator.value_bitmaps(rows, numbers, "offer_id")
    assert bitmaps.count() == 4
    (counted,) = operator.distinct_counts(bitmaps.unionByName(bitmaps), "offer_id").collect()
    assert tuple(counted) == ("hot", "affiliates", 100_000)


def test_the_log_of_the_other_tests_fits(spark, tmp_path):
    from tests.test_conversions import GOLDEN

    add_conversions(log_of(spark, GOLDEN), str(tmp_path / "s"), "a")
    assert counts_of(read_bitmaps(spark, str(tmp_path / "s"))) == {
        ("7", "affiliates"): 2,
        ("7", "geo"): 2,
        ("7", "zones"): 2,
    }


def test_an_offer_of_few_values_holds_few_words(spark):
    """Numbers far apart, as those of many partitions are, make no piece larger than its values."""
    far = (F.col("id") * 100_000 + 1).alias("number")
    text = F.col("id").cast("string").alias("value")
    numbers = spark.range(300).select(F.lit("affiliates").alias("dimension"), text, far)
    rows = spark.range(3000).select(
        F.concat(F.lit("o"), F.col("id") % 10).alias("offer_id"),
        F.lit("affiliates").alias("dimension"),
        (F.col("id") % 300).cast("string").alias("value"),
    )
    bitmaps = operator.value_bitmaps(rows, numbers, "offer_id")
    merged = operator.merge_bitmaps(bitmaps.unionByName(bitmaps), "offer_id")
    for frame in (bitmaps, merged):
        assert frame.select(F.sum(F.size("bits"))).first()[0] == 300
    counted = operator.distinct_counts(merged, "offer_id").collect()
    assert {(r.offer_id, r.n_values) for r in counted} == {(f"o{i}", 30) for i in range(10)}
    plan = operator.distinct_counts(bitmaps, "offer_id")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan

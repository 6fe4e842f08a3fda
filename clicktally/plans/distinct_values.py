"""Numbers of distinct affiliates, countries and zones per offer, kept up to date run by run.

A run adds the conversions it is given: values not seen before get numbers, and the bitmaps of its
conversions are stored in its own folder. Counts merge the bitmaps of all runs, or of some, such as those of
a week. Numbers are only ever added, and one is never used twice, so a run that is repeated, or that died
after it had numbered its values, changes no count. One run at a time may add to a store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktally.operators.conversions import dimension_values
from clicktally.operators.distinct_counts import (
    VALUE,
    distinct_counts,
    merge_bitmaps,
    number_values,
    value_bitmaps,
)
from clicktally.session import delete_path, fresh_path
from clicktally.sinks.tables import read_table

_TEXT = T.StringType()
_NUMBERS = T.StructType().add("dimension", _TEXT).add("value", _TEXT).add("number", T.LongType())
_BITMAPS = (
    T.StructType()
    .add("offer_id", _TEXT)
    .add("dimension", _TEXT)
    .add("piece", T.LongType())
    .add("bits", T.ArrayType(T.StructType().add("place", T.ShortType()).add("bits", T.LongType())))
    .add("run", _TEXT)
)


def _numbers(spark: SparkSession, store: str) -> DataFrame:
    return read_table(spark, f"{store}/numbers", _NUMBERS)


def read_bitmaps(spark: SparkSession, store: str) -> DataFrame:
    """The bitmaps of all runs per offer, dimension, piece and ``run``."""
    return read_table(spark, f"{store}/bitmaps", _BITMAPS)


def add_conversions(conversions: DataFrame, store: str, run: str) -> None:
    """Number the new values of the conversions and store their bitmaps as those of ``run``."""
    spark = conversions.sparkSession
    stored = fresh_path(spark, "dimension-values")
    offer = F.col("offer_id").cast("string").alias("offer_id")
    try:
        dimension_values(conversions).select(offer, *VALUE).write.parquet(stored)
        values = spark.read.parquet(stored)
        known = _numbers(spark, store)
        highest = known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("number"))
        new = values.select(*VALUE).distinct().join(known, list(VALUE), "left_anti")
        numbered = number_values(new, highest.first().number)  # one number
        numbered.write.mode("append").parquet(f"{store}/numbers")
        bitmaps = value_bitmaps(values, _numbers(spark, store), "offer_id")
        bitmaps.write.mode("overwrite").parquet(f"{store}/bitmaps/run={run}")
    finally:
        delete_path(spark, stored)


def merge_runs(spark: SparkSession, store: str, path: str) -> None:
    """Store the union of the bitmaps of all runs so far at ``path``, as large as that of one run."""
    merge_bitmaps(read_bitmaps(spark, store), "offer_id").write.mode("overwrite").parquet(path)


def offer_value_counts(bitmaps: DataFrame) -> DataFrame:
    """Distinct values per offer and dimension, from the bitmaps of any runs."""
    return distinct_counts(bitmaps, "offer_id")

"""Clicks, conversions and snapshots made from the star-schema test tables."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.functions import day_start
from clicktally.schemas import CLICK, CLICK_SNAPSHOT, CONVERSION_DAILY
from clicktally.session import fresh_path
from clicktally.sources import ClickLayout

TABLE_FOLDERS = "{stream}/year=%Y/month=%m/day=%d/hour=%H"
FOLDER_COLUMNS = ("stream", "year", "month", "day", "hour")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _time_text(length: int) -> Column:
    """The time of an event as text, down to the hour or minute."""
    return F.substring(F.col("ts").cast("string"), 1, length)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events under the names of the click columns, with the hour of their folder."""
    return table(spark, sf_dir, "events").select(
        "ts",
        F.col("event_type").alias("key_type"),
        F.col("user_id").cast("string").alias("offer_id"),
        F.floor(F.col("value") / 50).cast("string").alias("offer_advertiser_id"),
        F.col("props").alias("destination_subid"),
        "value",
        "user_id",
        F.translate(_time_text(13), "- ", "//").alias("hour"),
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("hour", *CLICK.names)


def _line(*columns) -> Column:
    return F.concat_ws("\t", *columns)


def click_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as click lines; those of errors break off after three tokens."""
    rows = events(spark, sf_dir)
    start = _line("key_type", F.lit("-"), "destination_subid")
    whole = _line(start, F.lit("-"), F.lit(""), "offer_advertiser_id", "offer_id", F.lit(""))
    broken = F.col("key_type") == "error"
    return rows.select("ts", "hour", F.when(broken, start).otherwise(whole).alias("value"))


_written: dict[tuple[str, str, bool], ClickLayout] = {}


def write_click_files(spark: SparkSession, sf_dir: str, plain: bool = False) -> ClickLayout:
    """Events as gzip click files, one folder per hour, in the stream of their day.

    The folders are ``name=digits``, or plain ones for the hours of the last day only, which Spark
    has to write one by one. A session writes them once.
    """
    application = spark.conf.get("spark.app.id")
    if (application, sf_dir, plain) in _written:
        return _written[application, sf_dir, plain]
    if plain:
        layout = _write_plain_files(spark, sf_dir)
        _written[application, sf_dir, plain] = layout
        return layout
    layout = _table_layout(spark)
    _write_table_files(click_lines(spark, sf_dir), layout)
    _written[application, sf_dir, plain] = layout
    return layout


def _table_layout(spark: SparkSession) -> ClickLayout:
    return ClickLayout(
        fresh_path(spark, "click-files"),
        odd_day_stream="stream=offer-stream-even",
        even_day_stream="stream=offer-stream-odd",
        hour_folder=TABLE_FOLDERS,
    )


def _write_table_files(lines: DataFrame, layout: ClickLayout) -> None:
    """Add files of lines to the folders of their hours."""
    parts = {
        name: F.split_part("hour", F.lit("/"), F.lit(place + 1))
        for place, name in enumerate(FOLDER_COLUMNS[1:])
    }
    (
        lines.withColumns(
            {**parts, "stream": F.substring_index(layout.stream_of(F.col("ts")), "=", -1)}
        )
        .select("value", *FOLDER_COLUMNS)
        .hint("rebalance", *FOLDER_COLUMNS)
        .write.mode("append")
        .partitionBy(*FOLDER_COLUMNS)
        .option("compression", "gzip")
        .text(layout.root)
    )


def deliver_click_files(spark: SparkSession, sf_dir: str) -> Iterator[ClickLayout]:
    """Events as click files in two deliveries; the second adds files to the hours of odd days."""
    layout = _table_layout(spark)
    lines = click_lines(spark, sf_dir)
    late = (F.dayofmonth("ts") % 2 == 1) & (F.crc32("value") % 2 == 0)
    for delivered in (~late, late):
        _write_table_files(lines.filter(delivered), layout)
        yield layout


def _write_plain_files(spark: SparkSession, sf_dir: str) -> ClickLayout:
    layout = ClickLayout(fresh_path(spark, "plain-click-files"))
    _, last = event_span(spark, sf_dir)
    lines = click_lines(spark, sf_dir).filter(F.col("ts") >= day_start(last))
    for hour in range(last.hour + 1):
        at = last.replace(hour=hour)
        rows = lines.filter(F.col("hour") == at.strftime("%Y/%m/%d/%H")).select("value")
        folder = layout.hour_glob(at).removesuffix("/*.gz")
        rows.coalesce(4).write.option("compression", "gzip").text(folder)
    return layout


def event_span(spark: SparkSession, sf_dir: str) -> tuple[datetime, datetime]:
    """The times of the first and the last event."""
    span = table(spark, sf_dir, "events").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    row = span.first()
    return row.a, row.b


def conversion_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as conversions, loaded some days after they happened.

    Money is the product of decimal factors and exact, since doubles would add up to another
    sum in another order.
    """
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    paid = price * F.col("l_discount").cast("decimal(4,2)")
    return table(spark, sf_dir, "lineitem").select(
        price.cast("decimal(18,4)").alias("received_revenue"),
        F.col("l_suppkey").cast("string").alias("offer_id"),
        paid.cast("decimal(18,4)").alias("paid_revenue"),
        F.col("l_partkey").cast("string").alias("affiliate_id"),
        F.col("l_returnflag").alias("geo_country"),
        F.when(F.col("l_linestatus") == "O", "")
        .otherwise(F.col("l_linestatus"))
        .alias("subid4"),
        F.col("l_shipdate").alias("conversion_time"),
        (F.col("l_shipdate") + F.make_dt_interval("l_linenumber")).alias("redshift_time"),
    )


def click_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a click snapshot of its minute."""
    return events(spark, sf_dir).select(
        _time_text(16).alias("key_dt"),
        *CLICK_SNAPSHOT.columns[1:-1],
        F.floor("value").cast("long").alias("count_of_clicks"),
    )


def conversion_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a conversion snapshot of its minute."""
    return events(spark, sf_dir).select(
        _time_text(16).alias("key_dt"),
        "key_type",
        F.col("offer_id").alias("offerid"),
        F.col("value").alias("received_revenue"),
        (F.col("value") / 2).alias("paid_revenue"),
        (F.col("value") - F.col("value") / 2).alias("roi"),
        F.col("user_id").alias("click_count"),
    ).select(*CONVERSION_DAILY.columns)

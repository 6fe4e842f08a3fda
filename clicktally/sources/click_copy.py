"""A cleaned copy of the click files: Parquet by day and hour, made for finding single clicks.

A gzip file has to be read whole by one task. The copy holds the parsed clicks of an hour in the order of
their destination subid, with a Bloom filter of these in every row group, so that a search reads the row
groups that may hold its id and skips the others by range and filter. An hour is replaced as a whole.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.functions import day_key
from clicktally.operators.clicks import click_rejects, parse_clicks
from clicktally.schemas import CLICK
from clicktally.sources.click_files import ClickLayout, read_click_lines

COPY_FOLDERS = ("day", "hour_of_day")
COPY_SCHEMA = f"{', '.join(f'{name} string' for name in CLICK.names)}, day string, hour_of_day string"
SEARCHED = "destination_subid"

# Bytes of a row group, and distinct ids that the Bloom filter of one is made for.
ROW_GROUP = 16 * 1024 * 1024
IDS_OF_GROUP = 200_000


def write_click_copy(
    spark: SparkSession,
    layout: ClickLayout,
    glob: str,
    path: str,
    rejects_path: str | None = None,
    row_group: int = ROW_GROUP,
) -> None:
    """Copy the clicks of the files of a glob, replacing the hours that have any.

    Ranges of the id within an hour go to one task each, so a large hour is split and its files do not
    overlap. With a path for rejects the files are read twice.
    """
    lines = read_click_lines(spark, layout, glob)
    folders = {
        "day": F.translate(F.substring("hour", 1, 10), "/", "-"),
        "hour_of_day": F.substring("hour", 12, 2),
    }
    order = [*COPY_FOLDERS, SEARCHED]
    (
        parse_clicks(lines)
        .withColumns(folders)
        .drop("hour")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.block.size", row_group)
        .option(f"parquet.bloom.filter.enabled#{SEARCHED}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{SEARCHED}", IDS_OF_GROUP)
        .partitionBy(*COPY_FOLDERS)
        .parquet(path)
    )
    if rejects_path is not None:
        click_rejects(lines).write.mode("overwrite").parquet(rejects_path)


def read_click_copy(
    spark: SparkSession, path: str, as_of: datetime | None = None
) -> DataFrame:
    """The copied clicks, all or those of the day of ``as_of`` (other folders unread)."""
    try:
        clicks = spark.read.schema(COPY_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COPY_SCHEMA)
    return clicks if as_of is None else clicks.filter(F.col("day") == day_key(as_of))

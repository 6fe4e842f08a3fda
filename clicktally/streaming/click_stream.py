"""Click counts kept up to date from a stream of click files.

Every file is read once. A micro-batch counts its lines, adds them to the counts so far of the hours
it touched, and stores these as the counts so far up to this batch, in folders by day, hour, checkpoint
and batch. The snapshots of the hours are made from that. The counts therefore live in a table that is
pruned by folder, not in a state store that would have to forget late hours, and a late file is counted
in its own hour. A batch reads one folder for each hour it touches, whatever came before.

A repeated batch starts from the counts before it, which are kept until a later batch of the hour is
stored, and replaces its own folders, so it changes nothing. The counts belong to one checkpoint, whose
id is part of their folders: a stream does not start over counts of another one, which would count
files twice.
"""

from __future__ import annotations

from concurrent.futures import Future

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicktally.operators.clicks import (
    as_click_snapshot,
    click_rejects,
    hour_end_key,
    merge_counts,
    parse_clicks,
    partial_counts,
)
from clicktally.schemas import CLICK_SNAPSHOT
from clicktally.session import delete_path, fresh_path
from clicktally.sinks import write_snapshots
from clicktally.sources import ClickLayout

COUNT_FOLDERS = ("day", "hour_of_day", "writer", "batch")
COUNTS_SCHEMA = (
    "hour string, offer_id string, offer_advertiser_id string, clicks long,"
    " lowest_type string, lowest_subid string"
)
STORED_SCHEMA = f"{COUNTS_SCHEMA}, day string, hour_of_day string, writer string, batch long"


class ForeignCounts(ValueError):
    """The counts belong to another checkpoint."""


def _day(hour: Column) -> Column:
    return F.translate(F.substring(hour, 1, 10), "/", "-")


def with_file_marks(lines: DataFrame, layout: ClickLayout) -> DataFrame:
    """Lines with the hour of their file, and whether it lies in the stream of its day."""
    path = F.col("_metadata.file_path")
    hour = layout.hour_of_path(path)
    stream = layout.stream_of(F.to_date(F.substring(hour, 1, 10), "yyyy/MM/dd"))
    return lines.select(
        "value",
        hour.alias("hour"),
        F.coalesce(layout.stream_of_path(path) == stream, F.lit(False)).alias("in_place"),
    )


def click_line_stream(
    spark: SparkSession, layout: ClickLayout, files_per_batch: int
) -> DataFrame:
    """New lines with their hour, and whether their file lies in the stream of its day."""
    anywhere = layout.hour_folder.format(stream="*")
    for part in ("%Y", "%m", "%d", "%H"):
        anywhere = anywhere.replace(part, "*")
    new = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return with_file_marks(new.text(f"{layout.root}/{anywhere}/*.gz"), layout)


def stream_rejects(lines: DataFrame) -> DataFrame:
    """Lines in files of the wrong stream, and lines in the right one that are not complete."""
    misplaced = lines.filter(~F.col("in_place")).withColumn("reason", F.lit("wrong stream"))
    broken = click_rejects(lines.filter("in_place"))
    return misplaced.unionByName(broken).select("value", "hour", "reason")


def _read_counts(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(STORED_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED_SCHEMA)


def _checkpoint_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id of the query that a checkpoint belongs to, if it has begun."""
    try:
        return spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _require_own_counts(spark: SparkSession, counts_path: str, checkpoint: str) -> None:
    own = _checkpoint_id(spark, checkpoint)
    counts = _read_counts(spark, counts_path).select("writer")
    foreign = counts.filter(~F.col("writer").eqNullSafe(F.lit(own))).take(1)
    if foreign:
        raise ForeignCounts(
            f"{counts_path} holds counts of {foreign[0].writer}, {checkpoint} is that of {own}"
        )


def _write_counts(rows: DataFrame, path: str) -> None:
    (
        rows.hint("rebalance", *COUNT_FOLDERS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*COUNT_FOLDERS)
        .parquet(path)
    )


def _with_hour_folders(counts: DataFrame) -> DataFrame:
    folders = {"day": _day(F.col("hour")), "hour_of_day": F.substring("hour", 12, 2)}
    return counts.withColumns(folders)


def counts_before(stored: DataFrame, new: DataFrame, writer: str, batch: int) -> DataFrame:
    """The counts before a batch of the hours in its ``new`` counts, found by their folders.

    Those of an hour are in the folder of the last batch before that touched it.
    """
    hours = ["day", "hour_of_day"]
    earlier = stored.filter((F.col("writer") == writer) & (F.col("batch") < batch))
    touched = earlier.join(_with_hour_folders(new).select(*hours).distinct(), hours, "left_semi")
    last = touched.groupBy(*hours).agg(F.max("batch").alias("batch"))
    return touched.join(last, [*hours, "batch"], "left_semi")


def _drop_older(spark: SparkSession, stored: DataFrame, path: str, writer: str, batch: int) -> None:
    """Delete the counts of hours that this batch touched but for its own and those before it."""
    hours = ["day", "hour_of_day"]
    own = stored.filter(F.col("writer") == writer).select(*hours, "batch").distinct()
    touched = own.join(own.filter(F.col("batch") == batch).select(*hours), hours, "left_semi")
    earlier = touched.filter(F.col("batch") < batch)
    last = earlier.groupBy(*hours).agg(F.max("batch").alias("last"))
    older = earlier.join(last, hours).filter(F.col("batch") < F.col("last"))
    # At most one folder for each hour of a batch, since every batch deletes them.
    for row in older.collect():
        folder = f"{path}/day={row.day}/hour_of_day={row.hour_of_day}/writer={writer}"
        delete_path(spark, f"{folder}/batch={row.batch}", folder)


def run_click_stream(
    spark: SparkSession,
    layout: ClickLayout,
    counts_path: str,
    snapshots_path: str,
    checkpoint: str,
    files_per_batch: int = 10_000,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Count all files that have arrived since the last run, then stop.

    A snapshot carries the last minute of its hour as key and is replaced as the hour grows. With a
    path for rejects the files of a batch are read twice.
    """
    _require_own_counts(spark, counts_path, checkpoint)
    started: Future[str] = Future()

    def store(lines: DataFrame, batch: int) -> None:
        session = lines.sparkSession
        writer = started.result()
        in_place = lines.filter("in_place").drop("in_place")
        scratch = fresh_path(session, "batch-counts")
        partial_counts(parse_clicks(in_place), "hour").write.parquet(scratch)
        new = session.read.schema(COUNTS_SCHEMA).parquet(scratch)
        before = counts_before(_read_counts(session, counts_path), new, writer, batch)
        merged = merge_counts(new.unionByName(before.select(*new.columns)), "hour")
        own = {"writer": F.lit(writer), "batch": F.lit(batch)}
        _write_counts(_with_hour_folders(merged).withColumns(own), counts_path)
        delete_path(session, scratch)
        if rejects_path is not None:
            folder = f"{rejects_path}/writer={writer}/batch={batch}"
            stream_rejects(lines).write.mode("overwrite").parquet(folder)
        stored = _read_counts(session, counts_path)
        counts = stored.filter((F.col("writer") == writer) & (F.col("batch") == batch))
        snapshot = as_click_snapshot(counts, hour_end_key(F.col("hour")))
        write_snapshots(snapshot, snapshots_path, CLICK_SNAPSHOT)
        _drop_older(session, stored, counts_path, writer, batch)

    query = (
        click_line_stream(spark, layout, files_per_batch)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.set_result(query.id)
    return query

"""Click counts held in the state store of a stream, as a second form beside the folders of counts.

The time of a click is the hour of its folder. The stream groups by hour, offer and advertiser in update
mode, with the state in RocksDB; a batch yields the groups that it changed, with their counts so far, and
these are stored as one more layer of their hours. The snapshot of an hour is the newest layer of each of
its groups. A batch therefore costs as much as it changes, and reads no counts but those layers of the
hours it touched; layers of an hour are joined into one when there are many.

The state forgets an hour once the watermark has passed it: the latest hour seen less a delay. Files of
such hours are not counted. Their lines are kept with the reason, together with the lines that cannot be
read; the file ledger recounts such hours (``plans.late_files``). Which files a batch had, and its
watermark, are taken from the log of the checkpoint, so a batch that is run again tells the same.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicktally.operators.clicks import (
    as_click_snapshot,
    hour_end_key,
    parse_clicks,
    partial_counts,
)
from clicktally.schemas import CLICK_SNAPSHOT
from clicktally.session import delete_path, fresh_path, settings_of
from clicktally.sinks import write_snapshots
from clicktally.sources import ClickLayout
from clicktally.streaming.click_stream import (
    COUNTS_SCHEMA,
    click_line_stream,
    stream_rejects,
    with_file_marks,
)

HOUR_FOLDERS = ("day", "hour_of_day")
LAYER_FOLDERS = (*HOUR_FOLDERS, "batch", "joined")
LAYERS_SCHEMA = f"{COUNTS_SCHEMA}, day string, hour_of_day string, batch long, joined int"
GROUP = ("hour", "offer_id", "offer_advertiser_id")

# Layers of an hour beyond which a batch joins those before its own into one.
MOST_LAYERS = 8

# Settings of the state. Late rows are told by the watermark of their own batch.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.statefulOperator.allowMultiple": "false",
}
SOURCE_LOG_SCHEMA = "path string, timestamp long, batchId long"


def _logged(spark: SparkSession, checkpoint: str, batch: int, field: str, none: int) -> int:
    """A number that the checkpoint notes of a batch before it begins."""
    try:
        log = spark.read.text(f"{checkpoint}/offsets/{batch}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return none
    found = log.agg(F.max(F.get_json_object("value", f"$.{field}").cast("long"))).first()[0]
    return none if found is None else found


def batch_watermark(spark: SparkSession, checkpoint: str, batch: int) -> int:
    """The watermark of a batch in milliseconds; 0 for none."""
    return _logged(spark, checkpoint, batch, "batchWatermarkMs", 0)


def batch_files(spark: SparkSession, checkpoint: str, batch: int) -> DataFrame:
    """``path`` of the files of a batch; a batch that only clears the state has none.

    The source counts the times it had files, and a batch notes the count it has come to.
    """
    last = _logged(spark, checkpoint, batch, "logOffset", -1)
    before = _logged(spark, checkpoint, batch - 1, "logOffset", -1)
    if last == before:
        return spark.createDataFrame([], "path string")
    log = spark.read.schema(SOURCE_LOG_SCHEMA).json(f"{checkpoint}/sources/0/{{{last},{last}.compact}}")
    return log.filter(F.col("batchId") == last).select("path").distinct()


def _hour_time(hour: str | Column) -> Column:
    return F.to_timestamp(hour, "yyyy/MM/dd/HH")


def _layers(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LAYERS_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LAYERS_SCHEMA)


def _newest(layers: DataFrame, *more: Column) -> DataFrame:
    """The newest layer of each group."""
    held = F.struct("clicks", "lowest_type", "lowest_subid")
    newest = layers.groupBy(*GROUP).agg(F.max_by(held, "batch").alias("held"), *more)
    return newest.select("*", "held.*").drop("held")


def _hour_folders() -> dict[str, Column]:
    day = F.translate(F.substring("hour", 1, 10), "/", "-")
    return {"day": day, "hour_of_day": F.substring("hour", 12, 2)}


def _store(rows: DataFrame, path: str, batch: Column, joined: int) -> None:
    """One layer for each hour of the rows."""
    (
        rows.withColumns({**_hour_folders(), "batch": batch, "joined": F.lit(joined)})
        .hint("rebalance", *LAYER_FOLDERS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LAYER_FOLDERS)
        .parquet(path)
    )


def join_layers(spark: SparkSession, layers: DataFrame, path: str, batch: int) -> None:
    """Join the layers before a batch of those hours of ``layers`` that have many.

    The joined layer has the number of the last one in it and a folder of its own, which is whole before
    anything is deleted and never written again. A batch that is run again finds either all layers or the
    joined one, and deletes what was left over.
    """
    hours = list(HOUR_FOLDERS)
    before = layers.filter(F.col("batch") < batch)
    folders = before.select(*LAYER_FOLDERS).distinct()
    crowded = (
        folders.groupBy(*hours)
        .agg(F.count("*").alias("n"), F.max("batch").alias("last"))
        .filter(F.col("n") > MOST_LAYERS)
        .select(*hours, "last")
    )
    # Some folders for each hour that a batch touched.
    outdated = folders.join(crowded, hours).filter("batch < last OR joined = 0").collect()
    if not outdated:
        return
    done = folders.join(crowded, hours).filter("batch = last AND joined = 1").select(*hours)
    scratch = fresh_path(spark, "joined-layers")
    fresh = before.join(crowded, hours).join(done, hours, "left_anti")
    last = F.first("last").alias("last")
    _newest(fresh, last).write.parquet(scratch)
    joined = spark.read.schema(f"{COUNTS_SCHEMA}, last long").parquet(scratch)
    _store(joined.withColumnRenamed("last", "batch"), path, F.col("batch"), 1)
    for row in outdated:
        folder = f"{path}/day={row.day}/hour_of_day={row.hour_of_day}/batch={row.batch}"
        delete_path(spark, f"{folder}/joined={row.joined}", folder)
    delete_path(spark, scratch)


def stateful_counts(lines: DataFrame, delay: str) -> DataFrame:
    """Counts so far per hour, offer and advertiser of a stream of lines.

    Hours that lie more than the delay before the latest one are forgotten.
    """
    timed = lines.withColumn("hour_time", _hour_time("hour")).withWatermark("hour_time", delay)
    return partial_counts(parse_clicks(timed), "hour_time", "hour")


def run_stateful_stream(
    spark: SparkSession,
    layout: ClickLayout,
    layers_path: str,
    snapshots_path: str,
    checkpoint: str,
    delay: str = "2 days",
    files_per_batch: int = 10_000,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Count all files that have arrived since the last run, then stop.

    With a path for rejects the files of a batch are read twice; late files go there anyway, if there is
    one. Layers and snapshots belong to one checkpoint.
    """
    def late_lines(session: SparkSession, batch: int) -> tuple[DataFrame, DataFrame]:
        """The lines of the files of a batch that came in time, and of those that did not."""
        hour = layout.hour_of_path(F.col("path"))
        mark = F.timestamp_millis(F.lit(batch_watermark(session, checkpoint, batch)))
        # At most as many as a batch takes.
        files = batch_files(session, checkpoint, batch).select(
            "path", (_hour_time(hour) <= mark).alias("late")
        )
        found = {True: [], False: []}
        for row in files.collect():
            found[bool(row.late)].append(row.path)

        def read(paths: list[str]) -> DataFrame:
            if not paths:
                return session.createDataFrame([], "value string, hour string, in_place boolean")
            return with_file_marks(session.read.text(paths), layout)

        return read(found[False]), read(found[True])

    def store(changed: DataFrame, batch: int) -> None:
        # The session of a stream with state plans without adaptive execution, which leaves out every
        # rebalance: each task would write a file for each hour. So it only stores what has changed.
        session = spark
        scratch = fresh_path(session, "changed-counts")
        changed.select(*GROUP, "clicks", "lowest_type", "lowest_subid").write.parquet(scratch)
        new = session.read.schema(COUNTS_SCHEMA).parquet(scratch)
        _store(new, layers_path, F.lit(batch), 0)
        # At most as many hours as a batch takes files. As a list they prune the folders, and nothing that
        # is planned on the layers still reads the changed counts when these are deleted.
        folder = F.concat_ws(" ", *_hour_folders().values())
        hours = [row[0] for row in new.select(folder).distinct().collect()]
        layers = _layers(session, layers_path).filter(F.col("batch") <= batch)
        touched = layers.filter(F.concat_ws(" ", *HOUR_FOLDERS).isin(hours))
        snapshot = as_click_snapshot(_newest(touched), hour_end_key(F.col("hour")))
        write_snapshots(snapshot, snapshots_path, CLICK_SNAPSHOT)
        if rejects_path is not None:
            on_time, late = late_lines(session, batch)
            rejects = stream_rejects(on_time).unionByName(
                late.select("value", "hour", F.lit("hour closed").alias("reason"))
            )
            rejects.write.mode("overwrite").parquet(f"{rejects_path}/batch={batch}")
        join_layers(session, touched, layers_path, batch)
        delete_path(session, scratch)

    lines = click_line_stream(spark, layout, files_per_batch).filter("in_place").drop("in_place")
    with settings_of(spark, STATE_SETTINGS):
        return (
            stateful_counts(lines, delay)
            .writeStream.outputMode("update")
            .foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

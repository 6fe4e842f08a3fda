"""Daily tables kept up to date from a stream of snapshots.

Snapshots are files that arrive in a folder. The stream groups them by day and offer (and type) and holds the
latest row of each group, the largest struct, as its state in RocksDB. A batch yields the groups whose
latest row may have changed, and only the days of these are read and replaced in the daily table. Where a run
of the batch job reads the snapshots of the day again, a batch of the stream reads the new ones.

The state forgets a day once the watermark has passed it: the latest day seen less a delay. Snapshots of
such days come too late to change the table, as those of earlier days do in the batch job. A batch that is run
again yields the same rows and upserts them again, which changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clicktally.functions import parsed_key
from clicktally.operators.latest import latest_clicks, latest_conversions
from clicktally.operators.upsert import upsert
from clicktally.plans.jobs import fitting_rows
from clicktally.schemas import (
    CLICK_DAILY,
    CLICK_SNAPSHOT,
    CLICK_UPDATES,
    CONVERSION_DAILY,
    CONVERSION_SNAPSHOT,
    CONVERSION_UPDATES,
    TableContract,
)
from clicktally.session import settings_of
from clicktally.sinks import finish_replacements, read_daily, stage_and_replace
from clicktally.sinks.tables import RUN_FOLDERS
from clicktally.streaming.stateful_counts import STATE_SETTINGS

# The column of the watermark; it goes into the groups and not into the result.
DAY_TIME = "day_time"


@dataclass(frozen=True)
class Consolidation:
    """Snapshots, the daily table of their latest rows, and what an upsert changes there."""

    snapshots: TableContract
    daily: TableContract
    changed: tuple[str, ...]
    latest: Callable[..., DataFrame]


CLICKS = Consolidation(CLICK_SNAPSHOT, CLICK_DAILY, CLICK_UPDATES, latest_clicks)
CONVERSIONS = Consolidation(
    CONVERSION_SNAPSHOT, CONVERSION_DAILY, CONVERSION_UPDATES, latest_conversions
)


def snapshot_stream(
    spark: SparkSession, path: str, contract: TableContract, files_per_batch: int
) -> DataFrame:
    """New snapshots of a folder, which may lie in folders of their day and minute.

    Files that are replaced before they are read are left out; those that replace them come later.
    """
    folders = [T.StructField(name, T.StringType()) for name in RUN_FOLDERS]
    rows = (
        spark.readStream.schema(T.StructType(contract.schema.fields + folders))
        .option("maxFilesPerTrigger", files_per_batch)
        .option("ignoreMissingFiles", "true")
        .parquet(path)
    )
    return rows.select(*contract.columns)


def latest_of_stream(snapshots: DataFrame, kind: Consolidation, delay: str) -> DataFrame:
    """The latest row of each group that a batch touched; snapshots without a minute or offer are left out."""
    timed = snapshots.withColumn(DAY_TIME, F.date_trunc("day", parsed_key(F.col("key_dt"))))
    open_days = timed.filter(F.col(DAY_TIME).isNotNull()).withWatermark(DAY_TIME, delay)
    return kind.latest(open_days, DAY_TIME)


def run_latest_stream(
    spark: SparkSession,
    kind: Consolidation,
    snapshots_path: str,
    target_path: str,
    staging_path: str,
    checkpoint: str,
    delay: str = "2 days",
    files_per_batch: int = 10_000,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Upsert the latest rows of all snapshots that have arrived since the last run, then stop.

    The result is that of the batch job run after each batch. One difference is left: if a snapshot is
    replaced by another of its minute, the greater of both counts, since the stream has seen both. With a
    path for rejects, rows that break the contract of the daily table go there; without, they end the run.
    """
    contract = kind.daily
    staging = f"{staging_path}/{contract.name}"

    def store(changed: DataFrame, batch: int) -> None:
        run = f"batch-{batch}"
        finish_replacements(spark, staging, target_path, contract)
        # The session of a stream with state plans without adaptive execution, which leaves out every
        # rebalance: each task would write a file for each day. So it only stores what has changed.
        with fitting_rows(changed, contract, rejects_path, run, spark) as rows:
            days = rows.select("key_dt").distinct()
            target = read_daily(spark, target_path, contract).join(days, "key_dt", "left_semi")
            merged = upsert(target.select(*contract.columns), rows, contract.key, kind.changed)
            stage_and_replace(merged, staging, run, target_path, contract)

    arrived = snapshot_stream(spark, snapshots_path, kind.snapshots, files_per_batch)
    with settings_of(spark, STATE_SETTINGS):
        return (
            latest_of_stream(arrived, kind, delay)
            .writeStream.outputMode("update")
            .foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

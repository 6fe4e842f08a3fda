"""Result tables as Parquet folders.

Snapshots lie in one folder per day and minute of their key, whichever job makes them, daily rows in
one per day. A write replaces the folders it stands for and no others, so a repeated run leaves
one copy, and none if there is nothing left to count. Rows are rebalanced by folder before a write: a
large folder is split over tasks, small ones share one.

Days are replaced by way of a staging folder and a note of what is staged, both deleted when the days are
in place. A job that starts first finishes what is noted, so a run that died leaves nothing to repair.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktally.functions import as_utc, day_key, day_of_key
from clicktally.schemas import TableContract
from clicktally.session import delete_path

RUN_FOLDERS = ("snapshot_day", "snapshot_run")
DAY_FOLDER = "key_dt"


def _replace_folders(rows: DataFrame, path: str, folders: tuple[str, ...]) -> None:
    (
        rows.hint("rebalance", *folders)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table by its schema, empty where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run_of_key(key_dt: Column) -> Column:
    """The run of a snapshot: the minute of its key, whichever job made it."""
    return F.translate(F.substring(key_dt, 12, 5), ":", "")


def write_run(rows: DataFrame, path: str, as_of: datetime) -> None:
    """Store the snapshots of one run in its folder; none empty the folder."""
    day, run = day_key(as_of), as_utc(as_of).strftime("%H%M")
    rows.write.mode("overwrite").parquet(f"{path}/snapshot_day={day}/snapshot_run={run}")


def write_snapshots(
    rows: DataFrame, path: str, contract: TableContract, covered: Column | None = None
) -> None:
    """Store the snapshots of many minutes, each in the folder of its day and minute.

    ``covered`` tells by ``key_dt`` which minutes these rows are the whole of: a folder of such a
    minute that gets no rows is emptied. Their number is that of the minutes, not of the rows, which
    are read once more if there are such folders.
    """
    spark = rows.sparkSession
    key = F.col("key_dt")
    before = []
    if covered is not None:
        minutes = read_snapshots(spark, path, contract).filter(covered).select(key).distinct()
        before = [row.key_dt for row in minutes.collect()]
    folders = {"snapshot_day": day_of_key(key), "snapshot_run": run_of_key(key)}
    now = {row.key_dt for row in rows.select(key).distinct().collect()} if before else set()
    _replace_folders(rows.withColumns(folders), path, RUN_FOLDERS)
    nothing = spark.createDataFrame([], contract.schema)
    for minute in set(before) - now:
        write_run(nothing, path, datetime.fromisoformat(minute))


def read_snapshots(
    spark: SparkSession, path: str, contract: TableContract, as_of: datetime | None = None
) -> DataFrame:
    """Snapshots, all or those since the start of the day of ``as_of`` (older folders unread)."""
    schema = T.StructType(
        contract.schema.fields + [T.StructField(name, T.StringType()) for name in RUN_FOLDERS]
    )
    rows = read_table(spark, path, schema)
    if as_of is not None:
        rows = rows.filter(F.col("snapshot_day") >= day_key(as_of))
    return rows.select(*contract.columns)


def read_daily(
    spark: SparkSession, path: str, contract: TableContract, as_of: datetime | None = None
) -> DataFrame:
    """Daily rows, all or those since the day of ``as_of`` (older folders unread)."""
    rows = read_table(spark, path, contract.schema)
    if as_of is not None:
        rows = rows.filter(F.col(DAY_FOLDER) >= day_key(as_of))
    return rows.select(*contract.columns)


def stage_days(rows: DataFrame, path: str) -> None:
    """Write complete days, in no folders yet, beside the table in which they replace others."""
    rows.write.mode("overwrite").parquet(path)


def replace_days(spark: SparkSession, staged: str, path: str, contract: TableContract) -> None:
    """Replace the staged days in the table at ``path``.

    Nothing is read from ``path``, so a replacement that was cut short is finished by calling
    this again with the same staged days.
    """
    _replace_folders(read_table(spark, staged, contract.schema), path, (DAY_FOLDER,))


_UNFINISHED = T.StructType(
    [T.StructField("staged", T.StringType()), T.StructField("target", T.StringType())]
    + [T.StructField("noted", T.TimestampType())]
)


def _notes(staging: str) -> str:
    return f"{staging}/unfinished"


def _finish(spark: SparkSession, staging: str, name: str, path: str, contract: TableContract) -> None:
    """Replace the days staged under a name, then delete the note of them and the staged copy."""
    replace_days(spark, f"{staging}/{name}", path, contract)
    delete_path(spark, f"{_notes(staging)}/run={name}", _notes(staging))
    delete_path(spark, f"{staging}/{name}", staging)


def finish_replacements(
    spark: SparkSession, staging: str, path: str, contract: TableContract
) -> None:
    """Replace the days that an earlier run staged for ``path`` and did not get to replace."""
    notes = read_table(spark, _notes(staging), _UNFINISHED)
    # One for each run that died since the last that did not.
    for row in notes.filter(F.col("target") == path).orderBy("noted").collect():
        _finish(spark, staging, row.staged.rpartition("/")[2], path, contract)


def stage_and_replace(
    rows: DataFrame, staging: str, name: str, path: str, contract: TableContract
) -> None:
    """Stage complete days under a name, note that, and replace them in the table.

    Neither the staged copy nor the note outlives the replacement.
    """
    spark = rows.sparkSession
    stage_days(rows, f"{staging}/{name}")
    note = spark.range(1).select(
        F.lit(f"{staging}/{name}").alias("staged"),
        F.lit(path).alias("target"),
        F.current_timestamp().alias("noted"),
    )
    note.write.mode("overwrite").parquet(f"{_notes(staging)}/run={name}")
    _finish(spark, staging, name, path, contract)

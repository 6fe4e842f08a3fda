"""Daily tables in buckets of their keys, so that an upsert shuffles the updates only.

A day is a folder per version, and the rows of a version lie in a fixed number of buckets by a hash of the
key. A run writes the days it changes as a new version and then notes it with the day; readers take the
latest noted version of each day. Nothing is replaced in place: a run that dies leaves a version that no
one reads, and a repeated one writes the same rows again. The version before the latest is kept for
readers that have begun with it, older ones are deleted.

Buckets need a table in the catalog of the session. It is made there when needed, over the folder, which
alone holds the state; with a Hive catalog set ``spark.sql.hive.manageFilesourcePartitions=false``, so that
versions are found in the folder.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktally.functions import day_key
from clicktally.schemas import TableContract
from clicktally.session import delete_path
from clicktally.sinks.tables import DAY_FOLDER, read_table

#: The hash of the key by which rows are dealt to buckets, and the folder of a version.
KEY_CODE, VERSION = "key_code", "version"
KEPT_VERSIONS = 2

_NOTES = T.StructType(
    [
        T.StructField(VERSION, T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField(DAY_FOLDER, T.StringType()),
    ]
)


class OtherBuckets(ValueError):
    """A table is in another number of buckets than the one asked for."""


@dataclass(frozen=True)
class BucketedDays:
    """A daily table below ``path``; the number of buckets stays the same for good."""

    path: str
    contract: TableContract
    buckets: int = 200

    @property
    def days(self) -> str:
        return f"{self.path}/days"

    @property
    def notes(self) -> str:
        return f"{self.path}/notes"

    @property
    def name(self) -> str:
        """The name in the catalog, which tells tables of one contract apart."""
        place = f"{self.path}\n{self.buckets}".encode()
        return f"{self.contract.name}_{hashlib.sha256(place).hexdigest()[:16]}"

    @property
    def columns(self) -> list[str]:
        """The columns as stored: the folders of day and version come last."""
        rest = [name for name in self.contract.columns if name != DAY_FOLDER]
        return [*rest, KEY_CODE, DAY_FOLDER, VERSION]


def key_code(contract: TableContract) -> Column:
    """The hash of the key of a row; a null part takes part as such."""
    return F.xxhash64(*contract.key)


def _in_catalog(spark: SparkSession, table: BucketedDays) -> str:
    types = {field.name: field.dataType.simpleString() for field in table.contract.schema}
    types |= {KEY_CODE: "bigint", VERSION: "string"}
    columns = ", ".join(f"`{name}` {types[name]}" for name in table.columns)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{table.name}` ({columns}) USING parquet "
        f"PARTITIONED BY ({DAY_FOLDER}, {VERSION}) "
        f"CLUSTERED BY ({KEY_CODE}) SORTED BY ({KEY_CODE}) INTO {table.buckets} BUCKETS "
        f"LOCATION '{table.days}'"
    )
    spark.catalog.refreshTable(table.name)
    return table.name


def _noted(spark: SparkSession, table: BucketedDays, as_of: datetime | None) -> DataFrame:
    """Notes of the days from that of ``as_of`` on (other folders unread)."""
    notes = read_table(spark, table.notes, _NOTES)
    return notes if as_of is None else notes.filter(F.col(DAY_FOLDER) >= day_key(as_of))


def _latest_versions(
    spark: SparkSession, table: BucketedDays, as_of: datetime | None
) -> dict[str, str]:
    """The version of each day that counts, by day."""
    rows = (
        _noted(spark, table, as_of)
        .groupBy(DAY_FOLDER)
        .agg(F.max(F.struct(VERSION, "buckets")).alias("latest"))
        .select(DAY_FOLDER, "latest.*")
        .collect()  # one for each day
    )
    for row in rows:
        if row.buckets != table.buckets:
            raise OtherBuckets(f"{table.path} has {row.buckets} buckets, not {table.buckets}")
    return {row[DAY_FOLDER]: row[VERSION] for row in rows}


def read_bucketed_days(
    spark: SparkSession, table: BucketedDays, as_of: datetime | None = None
) -> DataFrame:
    """Rows of the latest versions with the hash of their key, of all days or of those since ``as_of``."""
    latest = _latest_versions(spark, table, as_of)
    rows = spark.table(_in_catalog(spark, table))
    # Both are folders, so others are not read.
    place = F.concat(DAY_FOLDER, F.lit("/"), VERSION)
    counted = place.isin([f"{day}/{version}" for day, version in latest.items()])
    return rows.filter(counted if latest else F.lit(False)).select(
        *table.contract.columns, KEY_CODE
    )


def write_bucketed_days(rows: DataFrame, table: BucketedDays, as_of: datetime | None = None) -> None:
    """Store complete days, none before that of ``as_of``, as a new version, and note it.

    The rows have the hash of their key. Days without rows keep their version.
    """
    spark = rows.sparkSession
    before = _latest_versions(spark, table, as_of).values()
    number = 1 + max((int(version.partition("-")[0]) for version in before), default=0)
    version = f"{number:012d}-{uuid.uuid4().hex}"
    name = _in_catalog(spark, table)
    rows.withColumn(VERSION, F.lit(version)).select(*table.columns).write.insertInto(name)
    spark.catalog.refreshTable(name)
    _note_version(spark, table, version)
    _delete_old_versions(spark, table, version, as_of)


def _note_version(spark: SparkSession, table: BucketedDays, version: str) -> None:
    """Note a version with the days that it holds, which are those of its folders."""
    written = spark.table(table.name).filter(F.col(VERSION) == version)
    notes = written.select(VERSION, F.lit(table.buckets).alias("buckets"), DAY_FOLDER).distinct()
    notes.coalesce(1).write.mode("append").partitionBy(DAY_FOLDER).parquet(table.notes)


def _delete_old_versions(
    spark: SparkSession, table: BucketedDays, version: str, as_of: datetime | None
) -> None:
    """Delete what the days of a version held before the one before it."""
    notes = _noted(spark, table, as_of)
    days = notes.filter(F.col(VERSION) == version).select(DAY_FOLDER)
    versions = F.sort_array(F.collect_set(VERSION), asc=False)
    held = notes.join(days, DAY_FOLDER, "left_semi").groupBy(DAY_FOLDER).agg(
        F.slice(versions, KEPT_VERSIONS + 1, 2).alias("old")
    )
    # Two for each day: one more than a run leaves, for a run that died before it deleted its own.
    for row in held.collect():
        folder = f"{table.days}/{DAY_FOLDER}={row[DAY_FOLDER]}"
        for old in row.old:
            delete_path(spark, f"{folder}/{VERSION}={old}", folder)

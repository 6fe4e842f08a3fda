"""Sources in databases, read in parallel slices.

The slices are disjoint and cover the window, so every row is read once. Their text is made
from the batch time only, never from data. Columns not used later are not fetched. Address
and credentials come from the caller.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from clicktally.functions import as_utc, day_key, day_start
from clicktally.schemas import CONVERSION_LOG, TableContract


def snapshot_predicates(as_of: datetime, slices: int = 24) -> list[str]:
    """Slices of the day of ``as_of`` by minutes of equal number; the last has no upper end."""
    day = day_key(as_of)
    minutes = [24 * 60 * i // slices for i in range(1, slices)]
    bounds = [day] + [f"{day} {minute // 60:02d}:{minute % 60:02d}" for minute in minutes]
    slices = [
        f"key_dt >= '{low}' AND key_dt < '{high}'" for low, high in zip(bounds, bounds[1:])
    ]
    return [*slices, f"key_dt >= '{bounds[-1]}'"]


def read_snapshot_table(
    spark: SparkSession,
    url: str,
    contract: TableContract,
    as_of: datetime,
    properties: dict[str, str],
    slices: int = 24,
) -> DataFrame:
    """Snapshots of a table since the start of the day of ``as_of``."""
    rows = spark.read.jdbc(
        url,
        contract.name,
        predicates=snapshot_predicates(as_of, slices),
        properties=properties,
    )
    return rows.select(*contract.columns)


def conversion_predicates(
    as_of: datetime, since: datetime | None = None, slices: int = 24
) -> list[str]:
    """Slices of the rows that happened or were loaded in the window, both ends included.

    Rows that happened in the window are sliced by that time, the rest by their load time.
    """
    start = day_start(as_of) if since is None else as_utc(since)
    end = as_utc(as_of)
    span = int((end - start).total_seconds()) + 1
    slices = max(1, min(slices, span))
    bounds = [start + timedelta(seconds=span * i // slices) for i in range(slices + 1)]

    def within(column: str, low: datetime, high: datetime) -> str:
        return f"{column} >= TIMESTAMP '{low}' AND {column} < TIMESTAMP '{high}'"

    outside = (
        f"(conversion_time IS NULL OR conversion_time < TIMESTAMP '{bounds[0]}'"
        f" OR conversion_time >= TIMESTAMP '{bounds[-1]}')"
    )
    pairs = list(zip(bounds, bounds[1:]))
    happened = [within("conversion_time", low, high) for low, high in pairs]
    loaded = [f"{within('redshift_time', low, high)} AND {outside}" for low, high in pairs]
    return happened + loaded


def read_conversion_log(
    spark: SparkSession,
    url: str,
    table: str,
    as_of: datetime,
    properties: dict[str, str],
    since: datetime | None = None,
    slices: int = 24,
) -> DataFrame:
    """Conversions that happened or were loaded in the window of a run."""
    rows = spark.read.jdbc(
        url,
        table,
        predicates=conversion_predicates(as_of, since, slices),
        properties=properties,
    )
    return rows.select(*CONVERSION_LOG.names)

"""Batch times and the text keys made from them.

A job takes its batch time as the argument ``as_of``: a run can be repeated, and all rows of
one run carry one time. A time without a zone is taken to be UTC.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed formats of the text keys: of a minute for Spark and for Python, and of a day.
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"
MINUTE_KEY = "%Y-%m-%d %H:%M"
DAY_KEY = "%Y-%m-%d"


def as_utc(as_of: datetime) -> datetime:
    """``as_of`` as a UTC time without zone, to the second."""
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return as_of.replace(microsecond=0)


def day_start(as_of: datetime) -> datetime:
    return as_utc(as_of).replace(hour=0, minute=0, second=0)


def day_key(as_of: datetime) -> str:
    return as_utc(as_of).strftime(DAY_KEY)


def minute_key(as_of: datetime) -> str:
    return as_utc(as_of).strftime(MINUTE_KEY)


def time_literal(moment: datetime, data_type: T.DataType) -> Column:
    """A literal of the type of the column it is compared with.

    Comparing unlike timestamp types puts a cast around the column, and a cast column is not
    pushed to the scan.
    """
    text = as_utc(moment).strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit(text).cast(data_type)
    return F.lit(text + "+00:00").cast(T.TimestampType())


def day_of_key(key_dt: Column) -> Column:
    """The day part of a text key."""
    return F.substring(key_dt, 1, 10)


def parsed_key(key_dt: Column) -> Column:
    """The time of a text key, null where the text is not a minute key."""
    return F.try_to_timestamp(key_dt, F.lit(MINUTE_FORMAT))

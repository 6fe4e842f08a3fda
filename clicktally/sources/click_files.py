"""Click files: gzip text in one folder per hour, in one of two streams.

A gzip file is read by one task, so files set the parallelism of the scan; nothing is
shuffled before the first partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.functions import as_utc, day_start

LINES_SCHEMA = "value string, hour string"
FILES_SCHEMA = "path string, length long, modified timestamp, hour string"


@dataclass(frozen=True)
class ClickLayout:
    """Where the click files of an hour lie.

    The streams alternate by day of month, and an odd day uses the stream named even; swap the
    two for data written the other way. ``hour_folder`` is a time format of five parts: stream,
    year, month, day and hour, the last four as digits or as ``name=digits``.
    """

    root: str
    # The names of the streams and of the folders of an hour.
    odd_day_stream: str = "offer-stream-even"
    even_day_stream: str = "offer-stream-odd"
    hour_folder: str = "{stream}/%Y/%m/%d/%H"

    def stream(self, moment: datetime) -> str:
        return self.odd_day_stream if as_utc(moment).day % 2 else self.even_day_stream

    def hour_glob(self, as_of: datetime) -> str:
        """The files of the hour of ``as_of``."""
        return f"{self.root}/{self._folder(as_of)}/*.gz"

    def day_glob(self, as_of: datetime) -> str:
        """The files of the day of ``as_of``."""
        return f"{self.root}/{self._day_folders(as_of)}/*.gz"

    def range_glob(self, first: datetime, last: datetime) -> str:
        """The files of all hours from that of ``first`` to that of ``last``."""
        hour = as_utc(first).replace(minute=0, second=0)
        last = as_utc(last)
        folders = []
        while hour <= last:
            next_day = day_start(hour) + timedelta(days=1)
            if hour == day_start(hour) and next_day <= last + timedelta(hours=1):
                folders.append(self._day_folders(hour))
                hour = next_day
            else:
                folders.append(self._folder(hour))
                hour += timedelta(hours=1)
        return f"{self.root}/{{{','.join(folders)}}}/*.gz"

    def hours_glob(self, hours: Sequence[datetime]) -> str:
        """The files of some hours."""
        return f"{self.root}/{{{','.join(self._folder(hour) for hour in hours)}}}/*.gz"

    def hour_of_path(self, path: Column) -> Column:
        """The hour of a file as text, ``yyyy/MM/dd/HH``."""
        tail = F.substring_index(path, "/", -5)
        if "=" in self.hour_folder:
            tail = F.regexp_replace(tail, r"(^|/)[^/=]*=", "$1")
        return F.substring_index(tail, "/", 4)

    def stream_of_path(self, path: Column) -> Column:
        """The stream in which a file lies."""
        return F.substring_index(F.substring_index(path, "/", -6), "/", 1)

    def stream_of(self, time: Column) -> Column:
        """The stream that holds the clicks of a time."""
        return F.when(F.dayofmonth(time) % 2 == 1, self.odd_day_stream).otherwise(
            self.even_day_stream
        )

    def _folder(self, moment: datetime) -> str:
        return as_utc(moment).strftime(self.hour_folder).format(stream=self.stream(moment))

    def _day_folders(self, moment: datetime) -> str:
        day = self.hour_folder.replace("%H", "*")
        return as_utc(moment).strftime(day).format(stream=self.stream(moment))


def read_click_lines(
    spark: SparkSession, layout: ClickLayout, glob: str, without: Sequence[str] = ()
) -> DataFrame:
    """Lines of the files of a glob, each with the hour of its folder.

    Files named by ``without``, as ``_metadata.file_path`` gives them, are not opened. No file at all
    gives no lines; any other failure is raised.
    """
    try:
        lines = spark.read.text(glob)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LINES_SCHEMA)
    if without:
        lines = lines.filter(~F.col("_metadata.file_path").isin(list(without)))
    return lines.select("value", layout.hour_of_path(F.col("_metadata.file_path")).alias("hour"))


def list_click_files(spark: SparkSession, layout: ClickLayout, glob: str) -> DataFrame:
    """``path``, ``length``, ``modified`` and ``hour`` of the files of a glob; none are read."""
    try:
        files = spark.read.format("binaryFile").load(glob)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILES_SCHEMA)
    hour = layout.hour_of_path(F.col("path")).alias("hour")
    return files.select("path", "length", F.col("modificationTime").alias("modified"), hour)

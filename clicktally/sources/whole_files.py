"""Click files that cannot be read to their end, such as those still being written.

Spark either ends a job at such a file or leaves the rest of it out silently. Here each file of a glob is
unpacked to its end, a piece at a time, to tell which break off, where and why. A file is one row, and one
row is sent to Python at a time, so a worker holds one packed file; Spark reads up to 2 GB of it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.sources.click_files import ClickLayout

BROKEN_SCHEMA = "path string, file string, hour string, lines long, reason string"

# Packed bytes that are unpacked at once, and the largest piece of text made from them.
PIECE, UNPACKED = 1 << 20, 1 << 22
# Fixed value: the window setting by which zlib expects the header and checksum of gzip.
GZIP = zlib.MAX_WBITS | 16


def unpack_to_end(packed: memoryview) -> tuple[int, str | None]:
    """The whole lines of a gzip file, and why it breaks off, or None if it is whole.

    A file may have several members, one after the other, and zero bytes behind them. An empty one is
    broken: not even its header is there.
    """
    lines, place, member = 0, 0, None
    try:
        while place < len(packed) or (member and member.unconsumed_tail):
            if member is None:
                if lines or place:
                    # Padding behind a member is no member.
                    while place < len(packed) and packed[place] == 0:
                        place += 1
                    if place == len(packed):
                        return lines, None
                member = zlib.decompressobj(GZIP)
            tail = member.unconsumed_tail
            piece = packed[place : place + PIECE] if not tail else tail
            place += 0 if tail else len(piece)
            lines += member.decompress(piece, UNPACKED).count(b"\n")
            if member.eof:
                place -= len(member.unused_data)
                member = None
    except zlib.error as error:
        return lines, str(error)
    if member is not None or not len(packed):
        return lines, "the file ends before its data does"
    return lines, None


def _broken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        for row in range(batch.num_rows):
            packed = memoryview(batch.column(names.index("content"))[row].as_buffer())
            lines, reason = unpack_to_end(packed)
            if reason is not None:
                kept = [batch.column(names.index(name)).slice(row, 1) for name in ("path", "file", "hour")]
                found = [pa.array([lines], pa.int64()), pa.array([reason], pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *found], names=["path", "file", "hour", "lines", "reason"]
                )


@contextmanager
def _one_file_at_a_time(spark: SparkSession) -> Iterator[None]:
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def write_broken_files(spark: SparkSession, layout: ClickLayout, glob: str, path: str) -> None:
    """Store the gzip files of a glob that break off: path, hour, whole lines before that, and reason.

    ``file`` is the path as ``_metadata.file_path`` gives it. No file at all gives no rows.
    """
    try:
        files = spark.read.format("binaryFile").load(glob)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        spark.createDataFrame([], BROKEN_SCHEMA).write.parquet(path)
        return
    file = F.col("_metadata.file_path")
    rows = files.select("path", file.alias("file"), layout.hour_of_path(file).alias("hour"), "content")
    with _one_file_at_a_time(spark):
        rows.mapInArrow(_broken, BROKEN_SCHEMA).write.parquet(path)

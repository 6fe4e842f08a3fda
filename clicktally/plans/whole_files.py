"""Click jobs that go on without the files that break off.

A file that is still being written, or was cut short, must not end the job of its hour. A job is first run
over all files. If that fails, each file is unpacked to its end; those that break off are told as rejects, with
the lines before the break, and the job runs again over the others, whole. If none does, the failure
had another reason and stands. So a run without such files reads nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from clicktally.plans.rejects import write_rejects
from clicktally.session import delete_path, fresh_path
from clicktally.sources import ClickLayout, read_click_lines, write_broken_files
from clicktally.sources.whole_files import BROKEN_SCHEMA


def over_whole_files[Result](
    spark: SparkSession,
    layout: ClickLayout,
    glob: str,
    rejects_path: str | None,
    run: str,
    job: Callable[[DataFrame], Result],
) -> tuple[Result, list[str]]:
    """What ``job`` makes of the lines of the whole files of a glob, and the paths of the others.

    The others go to ``files`` below the path for rejects; without one the failure stands. ``job`` must
    give the same when it is run again after a failure.
    """
    if rejects_path is None:
        return job(read_click_lines(spark, layout, glob)), []
    rejects = f"{rejects_path}/files"
    try:
        result = job(read_click_lines(spark, layout, glob))
    except (PySparkException, Py4JJavaError):
        stored = fresh_path(spark, "broken-files")
        try:
            write_broken_files(spark, layout, glob, stored)
            broken = spark.read.schema(BROKEN_SCHEMA).parquet(stored)
            # Paths that are left out, no texts; files that break off are few, or the source is at fault.
            left_out = broken.select("path", "file").collect()
            if not left_out:
                raise
            lines = read_click_lines(spark, layout, glob, [row.file for row in left_out])
            result = job(lines)
            write_rejects(broken.drop("file"), rejects, run)
        finally:
            delete_path(spark, stored)
        return result, [row.path for row in left_out]
    write_rejects(spark.createDataFrame([], BROKEN_SCHEMA).drop("file"), rejects, run)
    return result, []

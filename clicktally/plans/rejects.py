"""Where the rejects of a run are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_rejects(rejects: DataFrame, path: str | None, run: str) -> None:
    """Keep the rejects of a run in the folder of the run; none empty it."""
    if path is not None:
        rejects.write.mode("overwrite").parquet(f"{path}/run={run}")

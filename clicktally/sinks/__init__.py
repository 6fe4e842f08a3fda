from clicktally.sinks.bucketed import (
    BucketedDays,
    key_code,
    read_bucketed_days,
    write_bucketed_days,
)
from clicktally.sinks.databases import append_rows, upsert_rows, upsert_statement
from clicktally.sinks.tables import (
    finish_replacements,
    read_daily,
    read_snapshots,
    replace_days,
    stage_and_replace,
    stage_days,
    write_run,
    write_snapshots,
)

__all__ = [
    "BucketedDays",
    "append_rows",
    "finish_replacements",
    "key_code",
    "read_bucketed_days",
    "read_daily",
    "read_snapshots",
    "replace_days",
    "stage_and_replace",
    "stage_days",
    "upsert_rows",
    "upsert_statement",
    "write_bucketed_days",
    "write_run",
    "write_snapshots",
]

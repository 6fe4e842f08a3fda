from clicktally.sources.click_copy import read_click_copy, write_click_copy
from clicktally.sources.click_files import ClickLayout, list_click_files, read_click_lines
from clicktally.sources.databases import (
    conversion_predicates,
    read_conversion_log,
    read_snapshot_table,
    snapshot_predicates,
)
from clicktally.sources.whole_files import write_broken_files

__all__ = [
    "ClickLayout",
    "conversion_predicates",
    "list_click_files",
    "read_click_copy",
    "read_click_lines",
    "read_conversion_log",
    "read_snapshot_table",
    "snapshot_predicates",
    "write_broken_files",
    "write_click_copy",
]

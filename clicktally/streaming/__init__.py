from clicktally.streaming.click_stream import run_click_stream
from clicktally.streaming.latest_rows import (
    CLICKS,
    CONVERSIONS,
    Consolidation,
    run_latest_stream,
)
from clicktally.streaming.stateful_counts import run_stateful_stream

__all__ = [
    "CLICKS",
    "CONVERSIONS",
    "Consolidation",
    "run_click_stream",
    "run_latest_stream",
    "run_stateful_stream",
]

from clicktally.functions.timekeys import (
    MINUTE_FORMAT,
    as_utc,
    day_key,
    day_of_key,
    day_start,
    minute_key,
    parsed_key,
    time_literal,
)

__all__ = [
    "MINUTE_FORMAT",
    "as_utc",
    "day_key",
    "day_of_key",
    "day_start",
    "minute_key",
    "parsed_key",
    "time_literal",
]

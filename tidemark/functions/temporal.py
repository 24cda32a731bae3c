"""Time columns, all read in the session zone."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day format and the microseconds of each interval unit.
DAY_FORMAT = "yyyy-MM-dd"
UNIT_MICROS = {
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def day_of(ts: str | Column) -> Column:
    return F.date_format(ts, DAY_FORMAT)


def hour_of(ts: str | Column, dtype: str = "int") -> Column:
    """Hour of the day, 0 to 23; not an hour bucket."""
    return F.hour(ts).cast(dtype)


def to_millis(ts: str | Column) -> Column:
    """The timestamp cut to milliseconds."""
    return F.date_trunc("millisecond", ts)


def from_epoch_millis(ms: int | str | Column) -> Column:
    return F.timestamp_millis(F.lit(ms) if isinstance(ms, int) else ms)


def micros(ts: str | Column) -> Column:
    """Microseconds since the epoch; timestamps without a zone are read in the session zone."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def interval_micros(text: str | int | None) -> int:
    """``'10 seconds'`` as microseconds."""
    if text is None:
        return 0
    if isinstance(text, int):
        return text
    match = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", text)
    if not match or match[2] not in UNIT_MICROS:
        raise ValueError(f"not an interval: {text!r}")
    return int(match[1]) * UNIT_MICROS[match[2]]

"""Epoch-millis and clock helpers. Sessions run in UTC; `tz` shifts to a local clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT = "yyyy-MM-dd HH:mm:ss"
TEXT_MILLIS = "yyyy-MM-dd HH:mm:ss.SSS"
DAY = "yyyy-MM-dd"
HALF_MINUTE_MS = 30_000


def to_millis(ts: Column) -> Column:
    """Timestamp (with or without zone) -> epoch millis."""
    return F.unix_millis(ts.cast("timestamp"))


def text_to_millis(text: Column) -> Column:
    """Epoch millis held as text; NULL where it is no number."""
    return text.try_cast("bigint")


def millis_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def local_ts(ms: Column, tz: str = "UTC") -> Column:
    ts = millis_to_ts(ms)
    return ts if tz == "UTC" else F.from_utc_timestamp(ts, tz)


def format_millis(ms: Column, pattern: str = TEXT, tz: str = "UTC") -> Column:
    return F.date_format(local_ts(ms, tz), pattern)


def parse_millis(text: Column, pattern: str = TEXT, tz: str = "UTC") -> Column:
    """Clock text in `tz` -> epoch millis; NULL where it does not parse."""
    ts = F.try_to_timestamp(text, F.lit(pattern))
    return F.unix_millis(ts if tz == "UTC" else F.to_utc_timestamp(ts, tz))


def floor_millis(ms: Column, step: int) -> Column:
    return (F.floor(ms / F.lit(step)) * step).cast("bigint")


def grid_start(start_ms: Column, step: int = HALF_MINUTE_MS) -> Column:
    """First grid point: the start floored to the step, plus one step."""
    return floor_millis(start_ms, step) + step


def grid_size(start_ms: Column, end_ms: Column, step: int = HALF_MINUTE_MS) -> Column:
    """Number of grid points up to the end; the first point always counts."""
    span = end_ms - grid_start(start_ms, step)
    return F.greatest(F.floor(span / F.lit(step)) + 1, F.lit(1)).cast("bigint")


def seconds_to_minutes(text: Column) -> Column:
    """Seconds held as text -> minutes with one decimal."""
    return F.round(F.coalesce(text.try_cast("double"), F.lit(0.0)) / 60, 1)


def is_day(text: Column) -> Column:
    return text.rlike(r"^\d{4}-\d{2}-\d{2}$")

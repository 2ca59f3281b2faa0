"""Event-time helpers: durations, epoch conversions, calendar buckets.

Batch tables carry ``timestamp_ntz`` holding UTC wall-clock time; fixture
readers produce the same. Conversions go through epoch microseconds so no
result depends on the session time zone.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_UNITS = {
    "us": 1, "microsecond": 1, "microseconds": 1,
    "ms": 1_000, "millisecond": 1_000, "milliseconds": 1_000,
    "s": 1_000_000, "sec": 1_000_000, "second": 1_000_000, "seconds": 1_000_000,
    "min": 60_000_000, "minute": 60_000_000, "minutes": 60_000_000,
    "h": 3_600_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
    "d": 86_400_000_000, "day": 86_400_000_000, "days": 86_400_000_000,
}


def to_micros(d) -> int:
    """'5 seconds' / '1 hour' / timedelta / number of seconds -> microseconds."""
    if isinstance(d, _dt.timedelta):
        return int(round(d.total_seconds() * 1_000_000))
    if isinstance(d, (int, float)):
        return int(round(d * 1_000_000))
    m = re.fullmatch(r"\s*([-+]?)\s*(\d+(?:\.\d+)?)\s*([a-zA-Z]+)\s*", str(d))
    if not m or m.group(3).lower() not in _UNITS:
        raise ValueError(f"cannot parse duration {d!r}")
    us = int(round(float(m.group(2)) * _UNITS[m.group(3).lower()]))
    return -us if m.group(1) == "-" else us


def interval_str(us: int) -> str:
    """Microseconds as a Spark interval string for ``window()``."""
    if us % 1_000_000 == 0:
        return f"{us // 1_000_000} seconds"
    return f"{us} microseconds"


def is_ntz(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.TimestampNTZType)


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Epoch microseconds of a timestamp or timestamp_ntz column.

    For timestamp_ntz the value is assembled from its wall-clock fields
    (date, hour, minute, fractional second): ``timestamp_diff`` would cast
    through the session time zone and shift by its offset and DST.
    """
    c = F.col(col)
    if is_ntz(df, col):
        days = F.unix_date(F.to_date(c)).cast("bigint")
        secs = F.date_part(F.lit("SECOND"), c)
        return (days * F.lit(86_400_000_000) + F.hour(c).cast("bigint") * F.lit(3_600_000_000)
                + F.minute(c).cast("bigint") * F.lit(60_000_000)
                + (secs * F.lit(1_000_000)).cast("bigint"))
    return F.unix_micros(c)


def _epoch_ntz() -> Column:
    # built from text: a Python datetime literal would pass through the session zone
    return F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())


def micros_to_ts(us: Column, ntz: bool = True) -> Column:
    """Inverse of :func:`epoch_micros` for the chosen timestamp flavour.

    ``timestamp_add`` on a timestamp_ntz operand works in UTC internally, so
    the result does not depend on the session zone (checked across a DST gap).
    """
    if not ntz:
        return F.timestamp_micros(us)
    return F.timestamp_add("MICROSECOND", us, _epoch_ntz())


def seconds_to_ts(c: Column) -> Column:
    """Epoch seconds -> timestamp_ntz (UTC wall clock)."""
    return micros_to_ts(c.cast("bigint") * F.lit(1_000_000))


def millis_to_ts(c: Column) -> Column:
    """Epoch milliseconds -> timestamp_ntz (UTC wall clock)."""
    return micros_to_ts(c.cast("bigint") * F.lit(1_000))


def as_event_time(df: DataFrame, col: str) -> Column:
    """timestamp (LTZ) view of a column, as ``withWatermark`` requires."""
    if is_ntz(df, col):
        return F.timestamp_micros(epoch_micros(df, col))
    return F.col(col)


def local_day(df: DataFrame, col: str, utc_offset_hours: int = 8) -> Column:
    """Calendar day at a fixed UTC offset (UTC+8 by default).

    The blacklist state resets at local midnight; this is the key that makes
    the reset explicit in batch form.
    """
    us = epoch_micros(df, col) + F.lit(utc_offset_hours * 3_600_000_000)
    return F.date_from_unix_date(F.floor(us / F.lit(86_400_000_000)).cast("int"))

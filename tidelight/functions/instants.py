"""Time expressions that work alike on TIMESTAMP and TIMESTAMP_NTZ columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNITS_US = {
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def micros_in(width: str) -> int:
    """``"1 second"`` -> 1000000."""
    found = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", width)
    if not found or found[2] not in _UNITS_US or int(found[1]) == 0:
        raise ValueError(f"not a time width: {width!r}")
    return int(found[1]) * _UNITS_US[found[2]]


def epoch_us(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_epoch_us(us: Column, like: str = "timestamp") -> Column:
    return F.timestamp_micros(us).cast(like)


def type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def bucket_us(ts: Column, width_us: int) -> Column:
    """Start of the tumbling bucket that holds ``ts``, in epoch microseconds."""
    return floor_to(epoch_us(ts), width_us)


def floor_to(value: Column, step: int) -> Column:
    return value - F.pmod(value, F.lit(step))


def elapsed_us(start: Column, end: Column) -> Column:
    return epoch_us(end) - epoch_us(start)


def latency_tenths(start: Column, end: Column) -> Column:
    """Tenths of a second between two instants, ties to even."""
    return F.bround(elapsed_us(start, end) / F.lit(100_000.0)).cast("long")


def latency_seconds(start: Column, end: Column) -> Column:
    """Seconds between two instants to one decimal, ties to even."""
    return latency_tenths(start, end) / F.lit(10.0)


def to_local(ts: Column, zone: str) -> Column:
    """Wall clock of a UTC instant in ``zone``."""
    return F.from_utc_timestamp(ts, zone)

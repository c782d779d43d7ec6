"""Event-time columns from epoch numbers, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(epoch: Column, unit: str = "ms") -> Column:
    """TIMESTAMP from an epoch number in milliseconds or seconds."""
    if unit == "ms":
        return F.timestamp_millis(epoch)
    if unit == "s":
        return F.timestamp_seconds(epoch)
    raise ValueError(f"unit must be 'ms' or 's', not {unit!r}")


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def epoch_us(ts: Column) -> Column:
    """Microseconds since the epoch; reads a TIMESTAMP_NTZ in the session time zone (UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def from_epoch_us(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def slot_start(at: Column, size: int) -> Column:
    """Start of the slot of length `size` that a whole number lies in, as window starts are."""
    return at - F.pmod(at, F.lit(size).cast("bigint"))


SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

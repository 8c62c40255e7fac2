"""Epoch-millisecond clocks: timestamps, local wall clock, date parts, latencies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLIS_PER_MINUTE = 60_000

# First and last epoch millisecond of the calendar years 1 to 9999.
# timestamp_millis overflows far outside this range and would fail the whole batch.
FIRST_MILLI = -62_135_596_800_000
LAST_MILLI = 253_402_300_799_999


def in_calendar(clock: Column) -> Column:
    """True for NULL and for clocks a timestamp can represent."""
    return clock.isNull() | clock.between(FIRST_MILLI, LAST_MILLI)


def local_time(epoch_ms: str, zone: str) -> Column:
    """Epoch milliseconds as a timestamp moved to the wall clock of a zone; NULL outside the calendar."""
    clock = F.col(epoch_ms)
    shown = F.when(in_calendar(clock), clock)
    return F.from_utc_timestamp(F.timestamp_millis(shown), zone)


def minutes_between(later: str, earlier: str) -> Column:
    """Minutes from one epoch-ms column to another, to two decimals; NULL if their distance overflows."""
    return F.round(F.try_subtract(F.col(later), F.col(earlier)) / MILLIS_PER_MINUTE, 2)


def date_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.day(ts),
        "insert_date": F.to_date(ts),
    }

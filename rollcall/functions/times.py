"""Clock and calendar expressions. All of them stay in code generation and none
depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_time(ts_utc: Column, zone: Column) -> Column:
    """Wall-clock time of a zone-less UTC timestamp, with the zone taken per row."""
    return F.convert_timezone(F.lit("UTC"), zone, ts_utc)


def epoch_second(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp.

    Built from its calendar fields: differences of timestamps would first be moved to the
    session's zone, where a clock change can hide or repeat an hour.
    """
    day = F.unix_date(ts.cast("date")).cast("bigint")
    return day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_crossed(start: Column, end: Column) -> Column:
    """Second boundaries between two timestamps (not elapsed time rounded down)."""
    return epoch_second(end) - epoch_second(start)


def epoch_minute(ts: Column) -> Column:
    day = F.unix_date(ts.cast("date")).cast("bigint")
    return day * 1440 + F.hour(ts) * 60 + F.minute(ts)


def minutes_crossed(start: Column, end: Column) -> Column:
    """Minute boundaries between two timestamps."""
    return epoch_minute(end) - epoch_minute(start)


def days_inclusive(start: Column, end: Column) -> Column:
    return F.date_diff(end, start) + 1


def cutover_date(ts_local: Column, hour: int) -> Column:
    """The day a tap belongs to by the clock alone: before `hour` it is still yesterday."""
    day = ts_local.cast("date")
    return F.when(F.hour(ts_local) < hour, F.date_sub(day, 1)).otherwise(day)


def iso_week(day: Column) -> Column:
    """`2025-W01`. The year is the ISO year, so the days around New Year stay in one week."""
    return F.concat(
        F.lpad(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), 4, "0"),
        F.lit("-W"),
        F.lpad(F.weekofyear(day).cast("string"), 2, "0"),
    )


def month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def is_weekend(day: Column) -> Column:
    return F.weekday(day).isin(5, 6)

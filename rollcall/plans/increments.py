"""Refresh of the daily tables: late rows name the days, and only these are built again."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.plans.estate import DAILY, Estate
from rollcall.settings import Settings
from rollcall.sources.days import DayRange, DayTables, LandedFeeds, Undated, feed_days, spans
from rollcall.sources.store import TableStore, sized

#: Feeds without days: whatever changes in them may change every day.
EVERYWHERE = ("workplace_dim", "dept_schedule")
INTERVALS = {"leave_requests": ("start_date", "end_date"), "travel_bookings": ("depart_date", "return_date")}


def affected_days(
    changes: Mapping[str, DataFrame], settings: Settings, feeds: Mapping[str, DataFrame]
) -> DataFrame:
    """Distinct days (`day`) whose daily tables depend on the changed rows, both old and new versions of them."""
    known = feed_days(feeds, "hr_employee_snapshot").unionByName(feed_days(feeds, "badge_taps"))
    bounds = known.agg(F.date_sub(F.min("dt"), 1).alias("lo"), F.date_add(F.max("dt"), 1).alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    look = settings.tap_look()

    def spread(feed: str, rows: DataFrame) -> DataFrame:
        if feed == "hr_employee_snapshot":
            return rows.select(F.col("snapshot_date").alias("day"))
        if feed in INTERVALS:
            start, end = INTERVALS[feed]
            cut = rows.select(F.greatest(start, lo).alias("first"), F.least(end, hi).alias("last")).distinct()
            return cut.where("first <= last").select(F.explode(F.sequence("first", "last")).alias("day"))
        if feed == "badge_taps" and look:
            back, ahead = look  # what a day looks back for, a tap bears on ahead
            day = F.col("tap_ts_utc").cast("date")
            return rows.select(day.alias("dt")).distinct().select(
                F.explode(F.sequence(F.date_sub("dt", ahead), F.date_add("dt", back))).alias("day")
            )
        return rows.limit(1).select(F.explode(F.sequence(lo, hi)).alias("day"))

    parts = [spread(feed, rows) for feed, rows in changes.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where("day IS NOT NULL").distinct()


def _in_parts(estate: Estate) -> Iterator[tuple[str, list[tuple[DayRange | Undated | None, DataFrame]]]]:
    """The daily tables, the two with the widest shuffles in parts of their days: disk holds those of one part at a time."""
    parts = estate.day_parts()
    if len(parts) > 1:
        estate.settle("int_tap_day")  # every part reads it
    for name in DAILY:
        some = parts if name in ("int_employee_day", "fct_attendance_daily") else [None]
        yield name, [(part, estate.of_part(name, part)) for part in some]


def build_daily(
    spark: SparkSession, root: str, tables: DayTables, settings: Settings | None = None
) -> None:
    """The daily tables of all landed days."""
    estate = Estate(spark, LandedFeeds(spark, root), settings, TableStore(spark))
    with sized(spark, estate.rows):
        for name, rows_of in _in_parts(estate):
            for n, (part, rows) in enumerate(rows_of):
                tables.write(name, rows, part, add=n > 0)
            estate.take(name, tables.read(name))
    estate.close()


def refresh(
    spark: SparkSession,
    root: str,
    tables: DayTables,
    changes: Mapping[str, DataFrame],
    settings: Settings | None = None,
) -> list[DayRange]:
    """Build the days that `changes` affect again, from landed partitions around them, and replace just these days.

    `changes` are rows that have landed since, and for rows that were replaced also their old version. The list of days
    is calendar-sized. Ranges closer than what a day looks back and ahead share partitions, so they are built at once.
    """
    settings = settings or Settings()
    feeds = LandedFeeds(spark, root)
    days: list[date] = [r["day"] for r in affected_days(changes, settings, feeds).collect()]
    look = settings.tap_look()
    ranges = spans(days, sum(look) if look else len(days))
    for span in ranges:
        estate = Estate(spark, feeds, settings, TableStore(spark), span)
        with sized(spark, estate.rows):
            for name, rows_of in _in_parts(estate):
                for part, rows in rows_of:
                    tables.replace(name, rows, span, part)
                estate.take(name, tables.read(name, span))
        estate.close()
    return ranges

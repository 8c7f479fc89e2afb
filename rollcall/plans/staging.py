"""Staging models: typed, flagged, localised feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import times
from rollcall.operators.anchors import anchor_day
from rollcall.operators.intervals import first_per_key
from rollcall.operators.repeats import drop_repeats


def hr_snapshot(raw: DataFrame) -> DataFrame:
    """Snapshot with the reported status next to the one its own dates imply."""
    day, term = F.col("snapshot_date"), F.col("term_date")
    left = term.isNotNull() & (day > term)
    early = day < F.col("hire_date")
    posted = F.col("assignment_city").isNotNull() & (F.col("employment_status") == "on_assignment")
    return raw.select(
        "snapshot_date",
        "emp_id",
        F.col("employment_status").alias("employment_status_reported"),
        "hire_date",
        "term_date",
        "badge_type",
        "employee_type",
        "dept_l1",
        "dept_l2",
        "dept_l3",
        "dept_l4",
        "base_city",
        "theory_workplace",
        "manager_id",
        "assignment_city",
        F.when(left, "terminated")
        .when(early, "onboarding")
        .when(posted, "on_assignment")
        .otherwise("active")
        .alias("employment_status_derived"),
        left.alias("is_post_exit"),
        early.alias("is_pre_hire"),
    )


def workplace_space(raw: DataFrame) -> DataFrame:
    """Floor-grain space. A missing zone falls back to UTC and leaves a flag."""
    return raw.select(
        "workplace_code",
        F.col("name").alias("workplace_name"),
        "city",
        "country",
        "region",
        F.coalesce("timezone", F.lit("UTC")).alias("timezone"),
        F.col("timezone").isNull().alias("has_missing_timezone"),
        "tower",
        "floor",
        "delivered_workstations",
        "allocated_workstations",
        "free_sharing_workstations",
        "net_workstation_area_sqm",
        "cost_per_workstation_month",
        "lease_expiry_date",
        "is_space_audited",
    )


def workplace(space: DataFrame) -> DataFrame:
    """Site-grain rollup of the floors."""
    same = ("city", "country", "region", "timezone")
    added = (
        "delivered_workstations",
        "allocated_workstations",
        "free_sharing_workstations",
        "net_workstation_area_sqm",
    )
    return space.groupBy("workplace_code").agg(
        F.min("workplace_name").alias("workplace_name"),
        *(F.min(c).alias(c) for c in same),
        F.bool_or("has_missing_timezone").alias("has_missing_timezone"),
        F.count(F.lit(1)).alias("floor_count"),
        F.count_distinct("tower").alias("tower_count"),
        *(F.sum(c).alias(c) for c in added),
        F.min("cost_per_workstation_month").alias("cost_per_workstation_month"),
        F.min("lease_expiry_date").alias("lease_expiry_date"),
        F.bool_and("is_space_audited").alias("is_space_audited"),
    )


def city_primary_workplace(sites: DataFrame) -> DataFrame:
    """The site meant when only a city is known: most desks first, then the lowest code."""
    biggest = [-F.col("delivered_workstations"), F.col("workplace_code")]
    return first_per_key(sites, ["city"], biggest, ["region", "workplace_code"]).select(
        "city", "region", F.col("workplace_code").alias("primary_workplace_code")
    )


def leave_requests(raw: DataFrame) -> DataFrame:
    return raw.select(
        "leave_id",
        "emp_id",
        "leave_type",
        "start_date",
        "end_date",
        "status",
        "applied_ts",
        (F.col("status") == "approved").alias("is_effective"),
        (F.col("applied_ts").cast("date") > F.col("start_date")).alias("is_retro_applied"),
        times.days_inclusive(F.col("start_date"), F.col("end_date")).alias("duration_days"),
    )


def travel_bookings(raw: DataFrame) -> DataFrame:
    return raw.select(
        "booking_id",
        "emp_id",
        "origin_city",
        "destination_city",
        "depart_date",
        "return_date",
        "booking_status",
        "hotel_flag",
        "flight_flag",
        (F.col("booking_status") == "confirmed").alias("is_effective"),
        times.days_inclusive(F.col("depart_date"), F.col("return_date")).alias("trip_days"),
    )


def dept_schedule(raw: DataFrame) -> DataFrame:
    return raw.select(
        "dept_l2",
        "dept_l1",
        "weekday",
        "is_scheduled_office_day",
        "required_days_per_week",
        "policy_version",
    )


TAP_KEYS = ["emp_id", "device_id", "direction"]


def known_site_taps(raw: DataFrame, sites: DataFrame) -> DataFrame:
    """Taps at sites that exist. Only the code takes part, so the shuffle after it stays narrow."""
    return raw.join(sites.select("workplace_code"), "workplace_code", "left_semi")


def kept_taps(raw: DataFrame, sites: DataFrame, repeat_window_seconds: int = 90) -> DataFrame:
    """Taps at known sites without re-swipes.

    Repeats depend on UTC time only, so the site's columns are attached later.
    """
    return drop_repeats(
        known_site_taps(raw, sites),
        TAP_KEYS,
        "tap_ts_utc",
        repeat_window_seconds,
        tie_break=("workplace_code", "tower", "floor", "ingested_date"),
    )


def localise(taps: DataFrame, sites: DataFrame) -> DataFrame:
    """Attach the site's zone and place, and the wall-clock time of the tap."""
    places = sites.select("workplace_code", "timezone", "city", "region", "has_missing_timezone")
    return taps.join(places, "workplace_code").withColumn(
        "tap_ts_local", times.local_time(F.col("tap_ts_utc"), F.col("timezone"))
    )


def local_hours(kept: DataFrame, sites: DataFrame) -> DataFrame:
    """Kept taps with local date and hour only, for consumers that need no business day."""
    ts = F.col("tap_ts_local")
    return localise(kept, sites).withColumns(
        {"local_date": ts.cast("date"), "local_hour": F.hour(ts)}
    )


def badge_taps(
    kept: DataFrame,
    sites: DataFrame,
    cutover_hour: int = 4,
    max_anchor_age_days: int | None = None,
) -> DataFrame:
    """Kept taps in local time, each on its business day. `kept` should be a stored table."""
    ts = F.col("tap_ts_local")
    anchored = anchor_day(
        localise(kept, sites),
        "emp_id",
        "tap_ts_local",
        is_entry=F.col("direction") == "in",
        clock_day=times.cutover_date(ts, cutover_hour),
        out="business_date",
        max_age_days=max_anchor_age_days,
    )
    return anchored.select(
        "emp_id",
        "workplace_code",
        "tower",
        "floor",
        "direction",
        "device_id",
        "tap_ts_utc",
        "tap_ts_local",
        ts.cast("date").alias("local_date"),
        "business_date",
        F.hour(ts).alias("local_hour"),
        "ingested_date",
        "timezone",
        "city",
        "region",
        "has_missing_timezone",
        (F.hour(ts) < cutover_hour).alias("is_overnight_tap"),
        (F.col("ingested_date") > ts.cast("date")).alias("is_late_reported"),
    )


def unknown_site_taps(raw: DataFrame, sites: DataFrame) -> DataFrame:
    """Taps per site code that staging leaves out because no such site exists."""
    return (
        raw.join(sites.select("workplace_code"), "workplace_code", "left_anti")
        .groupBy("workplace_code")
        .agg(F.count(F.lit(1)).alias("taps"))
    )

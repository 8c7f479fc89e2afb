"""Intermediate models: history, excused days, presence days and the employee-day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.measures import label
from rollcall.functions.times import minutes_crossed
from rollcall.operators.history import row_hash, versions
from rollcall.operators.intervals import expand_days, first_per_key

# The columns whose change opens a new employee version, in hash order.
TRACKED = [
    "employment_status_reported",
    "dept_l1",
    "dept_l2",
    "dept_l3",
    "dept_l4",
    "base_city",
    "theory_workplace",
    "manager_id",
    "assignment_city",
    "employee_type",
    "badge_type",
]
TRACKED_NULLABLE = ["base_city", "manager_id", "assignment_city"]

CARRIED = [
    "employment_status_reported",
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
]

# The state of an employee-day by the number of the rule that decided it.
STATES = {
    1: "post_exit",
    2: "pre_hire",
    3: "on_leave",
    4: "on_travel",
    5: "on_assignment",
    6: "non_office_day",
    7: "attended",
    8: "no_show",
}


def employee_history(hr: DataFrame, tasks: int | None = None) -> DataFrame:
    return versions(hr, "emp_id", "snapshot_date", row_hash(TRACKED, TRACKED_NULLABLE), CARRIED, tasks)


def leave_days(leave: DataFrame) -> DataFrame:
    """Approved leave per employee-day; overlapping requests collapse to the earliest applied."""
    days = expand_days(leave.where("is_effective"), "start_date", "end_date", "leave_date")
    order = [F.col("applied_ts"), F.col("leave_id")]
    kept = ["leave_type", "leave_id", "is_retro_applied"]
    return first_per_key(days, ["emp_id", "leave_date"], order, kept)


def travel_days(travel: DataFrame, city_primary: DataFrame) -> DataFrame:
    """Confirmed trips per employee-day; the lowest booking wins, then its destination's site."""
    days = expand_days(travel.where("is_effective"), "depart_date", "return_date", "travel_date")
    kept = ["destination_city", "origin_city", "booking_id"]
    picked = first_per_key(days, ["emp_id", "travel_date"], [F.col("booking_id")], kept)
    site = city_primary.select(
        F.col("city").alias("destination_city"),
        F.col("primary_workplace_code").alias("destination_workplace_code"),
    )
    return picked.join(site, "destination_city", "left").select(
        "emp_id",
        "travel_date",
        "destination_city",
        "origin_city",
        "booking_id",
        "destination_workplace_code",
    )


def tap_day(taps: DataFrame) -> DataFrame:
    """Presence per employee and business day. Place columns are those of the first tap."""
    ends = ("tap_ts_local", "tap_ts_utc", "workplace_code", "tower", "floor")
    by_day = taps.groupBy("emp_id", "business_date").agg(
        F.min(F.struct(*ends, "city", "region")).alias("_first"),
        F.max(F.struct(*ends)).alias("_last"),
        F.min("tap_ts_utc").alias("first_tap_ts_utc"),
        F.max("tap_ts_utc").alias("last_tap_ts_utc"),
        F.count(F.lit(1)).alias("tap_count"),
        F.count_distinct("workplace_code").alias("workplace_count"),
        F.bool_or("is_late_reported").alias("has_late_reported_tap"),
        F.bool_or("has_missing_timezone").alias("has_missing_timezone"),
        F.bool_or("is_overnight_tap").alias("has_overnight_tap"),
    )
    first, last = F.col("_first"), F.col("_last")
    return by_day.select(
        "emp_id",
        F.col("business_date").alias("local_date"),
        first.tap_ts_local.alias("first_tap_ts"),
        last.tap_ts_local.alias("last_tap_ts"),
        "first_tap_ts_utc",
        "last_tap_ts_utc",
        "tap_count",
        "workplace_count",
        first.workplace_code.alias("tap_workplace"),
        first.city.alias("tap_city"),
        first.region.alias("tap_region"),
        first.tower.alias("tower_first"),
        last.tower.alias("tower_last"),
        first.floor.alias("floor_first"),
        last.floor.alias("floor_last"),
        minutes_crossed(first.tap_ts_local, last.tap_ts_local).alias("span_minutes"),
        "has_late_reported_tap",
        "has_missing_timezone",
        "has_overnight_tap",
    )


def employee_day(
    hr: DataFrame,
    schedule: DataFrame,
    leave: DataFrame,
    travel: DataFrame,
    taps: DataFrame,
    city_primary: DataFrame,
) -> DataFrame:
    """One row per employee and snapshot day, resolved to exactly one state.

    Leave, travel and presence days arrive aggregated by (employee, day), the very keys they
    are joined on, so only the snapshot itself needs a shuffle for these joins. They grow with
    the feeds, hence the merge hint: they are never broadcast on the strength of an estimate.
    The policy and city tables carry no hint; the planner broadcasts them only below
    spark.sql.autoBroadcastJoinThreshold and shuffles them beyond it.
    """
    leave = leave.select(
        "emp_id", F.col("leave_date").alias("local_date"), "leave_type", F.lit(True).alias("_leave")
    )
    travel = travel.select(
        "emp_id",
        F.col("travel_date").alias("local_date"),
        "destination_city",
        "destination_workplace_code",
        F.lit(True).alias("_travel"),
    )
    policy = schedule.select(
        "dept_l2",
        F.col("weekday").alias("_weekday"),
        F.col("is_scheduled_office_day").alias("_policy"),
        "required_days_per_week",
    )
    posting = city_primary.select(
        F.col("city").alias("assignment_city"),
        F.col("primary_workplace_code").alias("_posting_site"),
    )
    day = ["emp_id", "local_date"]
    wide = (
        hr.withColumnRenamed("snapshot_date", "local_date")
        .withColumn("_weekday", F.weekday("local_date"))
        .join(leave.hint("merge"), day, "left")
        .join(travel.hint("merge"), day, "left")
        .join(taps.hint("merge"), day, "left")
        .join(policy, ["dept_l2", "_weekday"], "left")
        .join(posting, "assignment_city", "left")
    )

    gone, early = F.col("is_post_exit"), F.col("is_pre_hire")
    posted = F.coalesce(
        F.col("assignment_city").isNotNull()
        & (F.col("employment_status_reported") == "on_assignment"),
        F.lit(False),
    )
    present = F.col("first_tap_ts").isNotNull()
    flagged = wide.select(
        "*",
        F.coalesce("_policy", F.lit(False)).alias("_scheduled"),
        F.col("_leave").isNotNull().alias("is_on_leave"),
        F.col("_travel").isNotNull().alias("is_on_travel"),
        posted.alias("_posted"),
        present.alias("attended_flag"),
        (~gone & ~early).alias("is_incumbent"),
    )
    rule = (
        F.when(gone, 1)
        .when(early, 2)
        .when(F.col("is_on_leave"), 3)
        .when(F.col("is_on_travel"), 4)
        .when(F.col("_posted"), 5)
        .when(~F.col("_scheduled"), 6)
        .when(F.col("attended_flag"), 7)
        .otherwise(8)
    )
    status = (
        F.when(gone, "terminated")
        .when(early, "onboarding")
        .when(F.col("_posted"), "on_assignment")
        .when(F.col("employment_status_reported") == "pre_assignment", "pre_assignment")
        .otherwise("active")
    )
    owed = F.col("_scheduled") & F.col("is_incumbent")
    excused = F.col("is_on_leave") | F.col("is_on_travel") | F.col("_posted")
    state = F.col("state_rule_id")
    return flagged.withColumn("state_rule_id", rule).select(
        "emp_id",
        "local_date",
        "dept_l1",
        "dept_l2",
        "dept_l3",
        "dept_l4",
        "employee_type",
        "badge_type",
        "manager_id",
        "base_city",
        "hire_date",
        "term_date",
        "employment_status_reported",
        status.alias("employment_status_effective"),
        "assignment_city",
        F.coalesce(
            F.when(state == 5, F.col("_posting_site")),
            F.when(state == 4, F.col("destination_workplace_code")),
            F.col("theory_workplace"),
        ).alias("expected_workplace"),
        "theory_workplace",
        owed.alias("is_scheduled_office_day"),
        (owed & ~excused).alias("is_attendance_expected"),
        "required_days_per_week",
        "is_on_leave",
        "leave_type",
        "is_on_travel",
        "destination_city",
        (state == 5).alias("is_on_assignment"),
        "attended_flag",
        "first_tap_ts",
        "last_tap_ts",
        "tap_workplace",
        "tap_city",
        "tap_region",
        "tower_first",
        "tower_last",
        "floor_first",
        "floor_last",
        "tap_count",
        "workplace_count",
        "span_minutes",
        F.coalesce("has_late_reported_tap", F.lit(False)).alias("has_late_reported_tap"),
        "state_rule_id",
        label(state, STATES).alias("employee_day_state"),
        "is_incumbent",
    )


def weekday_policy(divisions: DataFrame, published: Column | None = None) -> DataFrame:
    """One policy row per division and weekday (Monday 0) from the office days it names.

    `divisions` holds dept_l2, dept_l1, office_days (array) and policy_version; `published`
    lists the weekdays to give rows for, all seven by default.
    """
    week = F.sequence(F.lit(0), F.lit(6)) if published is None else published
    return divisions.withColumn("weekday", F.explode(week)).select(
        "dept_l2",
        "dept_l1",
        "weekday",
        F.array_contains("office_days", F.col("weekday")).alias("is_scheduled_office_day"),
        F.size("office_days").alias("required_days_per_week"),
        "policy_version",
    )


def visible_days(
    people: DataFrame, start: Column, end: Column, before_hire: int = 14, after_exit: int = 30
) -> DataFrame:
    """Days on which each person appears in the snapshot, within [start, end].

    An interval expansion per person, so there is no range join.
    """
    first = F.greatest(F.date_sub("hire_date", before_hire), start)
    last = F.least(F.date_add("term_date", after_exit), end)
    return expand_days(
        people.select("*", first.alias("_from"), last.alias("_to")), "_from", "_to", "snapshot_date"
    ).drop("_from", "_to")

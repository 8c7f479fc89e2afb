"""Dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import times
from rollcall.functions.measures import available_desks, or_zero
from rollcall.operators.intervals import day_bounds


def dim_date(days: DataFrame, day: str) -> DataFrame:
    """Gap-free calendar over the range of `day`."""
    bounds = days.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    spine = bounds.where("lo IS NOT NULL").select(
        F.explode(F.sequence("lo", "hi")).alias("date_day")
    )
    d = F.col("date_day")
    return spine.select(
        "date_day",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.dayofweek(d) - 1).alias("day_of_week_sun0"),
        F.weekday(d).alias("weekday_mon0"),
        F.weekofyear(d).alias("iso_week"),
        times.iso_week(d).alias("iso_year_week"),
        times.is_weekend(d).alias("is_weekend"),
        F.date_format(d, "EEEE").alias("day_name"),
    )


def dim_employee(history: DataFrame, sites: DataFrame) -> DataFrame:
    """Latest version of each employee with the attributes of the home site."""
    home = sites.select(
        F.col("workplace_code").alias("theory_workplace"),
        F.col("city").alias("theory_city"),
        F.col("region").alias("theory_region"),
        F.col("country").alias("theory_country"),
    )
    return (
        history.where("is_current")
        .join(home, "theory_workplace", "left")
        .select(
            "emp_id",
            "version_number",
            "valid_from",
            "valid_to",
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
            "theory_city",
            "theory_region",
            "theory_country",
            F.col("base_city").isNull().alias("has_missing_base_city"),
        )
    )


def dim_workplace(sites: DataFrame, pooled_regions: tuple[str, ...] = ("CN",)) -> DataFrame:
    delivered, allocated = F.col("delivered_workstations"), F.col("allocated_workstations")
    desks = F.nullif(delivered, F.lit(0))
    return sites.select(
        "workplace_code",
        "workplace_name",
        "city",
        "country",
        "region",
        "timezone",
        "has_missing_timezone",
        F.col("region").isin(*pooled_regions).alias("is_china_region"),
        "tower_count",
        "floor_count",
        "delivered_workstations",
        "allocated_workstations",
        "free_sharing_workstations",
        (delivered - allocated).alias("unallocated_workstations"),
        available_desks(
            F.col("region"), allocated, F.col("free_sharing_workstations"), pooled_regions
        ).alias("available_workstations"),
        "net_workstation_area_sqm",
        F.round(F.col("net_workstation_area_sqm") / desks, 2).alias("sqm_per_workstation"),
        "cost_per_workstation_month",
        "lease_expiry_date",
        "is_space_audited",
    )


def fct_attendance_daily(days: DataFrame, sites: DataFrame) -> DataFrame:
    """Attendance by day, *expected* site and division: every measure in one aggregation.

    The site's city and region depend on the site alone, so they are attached after the
    aggregation, to the few rows that are left.
    """

    def in_state(name: str) -> Column:
        return F.col("employee_day_state") == name

    came, due = F.col("attended_flag"), F.col("is_attendance_expected")
    scheduled = F.col("is_scheduled_office_day")
    counted = {
        "headcount_incumbent": F.col("is_incumbent"),
        "scheduled_office_days": scheduled,
        "attendance_daily": came,
        "scheduled_attendance": scheduled & came,
        "attendance_expected_days": due,
        "attendance_expected_met": due & came,
        "no_show_days": in_state("no_show"),
        "leave_days": F.col("is_on_leave"),
        "travel_days": F.col("is_on_travel"),
        "assignment_days": F.col("is_on_assignment"),
        "non_office_days": in_state("non_office_day"),
        "post_exit_days": in_state("post_exit"),
        "pre_hire_days": in_state("pre_hire"),
        "late_reported_tap_days": F.col("has_late_reported_tap"),
    }
    place = sites.select("workplace_code", "city", "region")
    measures = [
        F.count(F.lit(1)).alias("employee_days"),
        *(F.count_if(flag).alias(name) for name, flag in counted.items()),
        F.avg(F.when(came, F.col("span_minutes"))).alias("avg_span_minutes"),
        F.max("required_days_per_week").alias("required_days_per_week"),
    ]
    keys = ["local_date", "workplace_code", "dept_l1", "dept_l2"]
    return (
        days.withColumnRenamed("expected_workplace", "workplace_code")
        .groupBy(*keys)
        .agg(*measures)
        .join(place, "workplace_code", "left")
        .select(
            "local_date",
            times.iso_week(F.col("local_date")).alias("iso_year_week"),
            "workplace_code",
            "city",
            "region",
            "dept_l1",
            "dept_l2",
            "employee_days",
            *counted,
            "avg_span_minutes",
            "required_days_per_week",
        )
    )


def fct_workplace_capacity_daily(
    days: DataFrame, sites: DataFrame, calendar_from: DataFrame, calendar_day: str
) -> DataFrame:
    """Supply against presence for every site and every day of the calendar.

    Each employee-day contributes to its expected site and, when it has a tap, to the site
    tapped at; both go through one aggregation, so the employee-day is read once. The dense
    spine is each site exploded over the calendar (two scalar bounds), which is no cross join.
    `calendar_from` only has to have the same first and last day as `days`; the HR snapshot
    does, since every snapshot row becomes an employee-day.
    """
    here = F.struct(
        F.col("tap_workplace").alias("workplace_code"),
        F.col("dept_l2").alias("dept"),
        F.lit(1).alias("present"),
        F.lit(0).alias("incumbent"),
    )
    expected = F.struct(
        F.col("expected_workplace").alias("workplace_code"),
        F.lit(None).cast("string").alias("dept"),
        F.lit(0).alias("present"),
        F.col("is_incumbent").cast("int").alias("incumbent"),
    )
    both = F.when(F.col("attended_flag"), F.array(here, expected)).otherwise(F.array(expected))
    demand = (
        days.select("local_date", F.inline(both))
        .groupBy("local_date", "workplace_code")
        .agg(
            F.sum("incumbent").alias("_incumbent"),
            F.sum("present").alias("_present"),
            F.count_distinct("dept").alias("_departments"),
        )
    )
    first, last = day_bounds(calendar_from, calendar_day)
    spine = sites.select(
        F.explode(F.sequence(first, last)).alias("local_date"),
        "workplace_code",
        "city",
        "region",
        "is_china_region",
        "delivered_workstations",
        "allocated_workstations",
        "free_sharing_workstations",
        "unallocated_workstations",
        "available_workstations",
        "cost_per_workstation_month",
        "net_workstation_area_sqm",
    )
    present, incumbents = or_zero(F.col("_present")), or_zero(F.col("_incumbent"))
    day = F.col("local_date")
    return spine.join(demand, ["local_date", "workplace_code"], "left").select(
        "local_date",
        "workplace_code",
        "city",
        "region",
        "is_china_region",
        times.is_weekend(day).alias("is_weekend"),
        times.iso_week(day).alias("iso_year_week"),
        "delivered_workstations",
        "allocated_workstations",
        "free_sharing_workstations",
        "unallocated_workstations",
        "available_workstations",
        "cost_per_workstation_month",
        "net_workstation_area_sqm",
        incumbents.alias("headcount_incumbent"),
        present.alias("attendance_actual"),
        or_zero(F.col("_departments")).alias("departments_present"),
        (F.col("available_workstations") - present).alias("workstation_waste"),
        F.greatest(incumbents - F.col("allocated_workstations"), F.lit(0)).alias(
            "floating_headcount"
        ),
    )


def fct_floor_presence_hourly(taps: DataFrame) -> DataFrame:
    """Movement past the readers by local hour."""
    return taps.groupBy("local_date", "workplace_code", "tower", "floor", "local_hour").agg(
        F.count(F.lit(1)).alias("tap_events"),
        F.count_distinct("emp_id").alias("employees_seen"),
        F.count_if(F.col("direction") == "in").alias("tap_ins"),
        F.count_if(F.col("direction") == "out").alias("tap_outs"),
    )

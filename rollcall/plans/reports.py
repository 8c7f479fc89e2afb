"""Aggregates behind the published reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.measures import label, ratio
from rollcall.plans.metrics import METRICS, MetricLayer

# The report group of each employee-day state, and the groups in reading order.
GROUP_OF = {
    "attended": "attended",
    "no_show": "no_show",
    "non_office_day": "not_scheduled",
    "on_leave": "excused",
    "on_travel": "excused",
    "on_assignment": "excused",
    "pre_hire": "not_employed",
    "post_exit": "not_employed",
}
GROUPS = ("attended", "no_show", "not_scheduled", "excused", "not_employed")


def state_counts(days: DataFrame) -> DataFrame:
    return days.groupBy("local_date", "employee_day_state").agg(
        F.count(F.lit(1)).alias("employee_days")
    )


def state_composition(days: DataFrame) -> DataFrame:
    """Employee-days per date, one column per report group, absent groups 0."""
    return (
        state_counts(days)
        .withColumn("group", label(F.col("employee_day_state"), GROUP_OF))
        .groupBy("local_date")
        .pivot("group", list(GROUPS))
        .agg(F.sum("employee_days"))
        .na.fill(0)
    )


def supply_ladder(capacity: DataFrame) -> DataFrame:
    """Per region: what is built, allocated, on offer, and used at the peak and on average."""
    weekday = F.when(~F.col("is_weekend"), F.col("attendance_actual"))
    per_site = capacity.groupBy("region", "workplace_code").agg(
        F.max("delivered_workstations").alias("delivered"),
        F.max("allocated_workstations").alias("allocated"),
        F.max("available_workstations").alias("available"),
        F.max(weekday).alias("peak_attendance"),
        F.avg(weekday).alias("mean_attendance"),
    )
    steps = ("delivered", "allocated", "available", "peak_attendance", "mean_attendance")
    return per_site.groupBy("region").agg(*(F.sum(c).alias(c) for c in steps))


def recovery(layer: MetricLayer, truth: DataFrame) -> DataFrame:
    """Attendance rate per region against a known one; `truth` holds (region, planted)."""
    found = layer.evaluate("attendance_rate", ["region"])
    return found.join(truth, "region", "left").select(
        "region",
        "planted",
        F.col("attendance_rate").alias("recovered"),
        F.abs(F.col("attendance_rate") - F.col("planted")).alias("abs_error"),
    )


def realised_rates(
    hr: DataFrame, schedule: DataFrame, leave: DataFrame, travel: DataFrame, taps, sites: DataFrame
) -> DataFrame:
    """Owed and met days per home region, recomputed from the staged feeds.

    Takes another road than the employee-day table: a set of excused days is removed by an
    anti join and presence is a semi join flag, with no state cascade.
    """
    day = ["emp_id", "local_date"]
    off = leave.select("emp_id", F.col("leave_date").alias("local_date")).unionByName(
        travel.select("emp_id", F.col("travel_date").alias("local_date"))
    )
    office = schedule.where("is_scheduled_office_day").select(
        "dept_l2", F.col("weekday").alias("_weekday")
    )
    posted = F.col("assignment_city").isNotNull() & (
        F.col("employment_status_reported") == "on_assignment"
    )
    owed = (
        hr.where(~F.col("is_post_exit") & ~F.col("is_pre_hire") & ~posted)
        .withColumnRenamed("snapshot_date", "local_date")
        .withColumn("_weekday", F.weekday("local_date"))
        .join(office, ["dept_l2", "_weekday"], "left_semi")
        .join(off.hint("merge"), day, "left_anti")
        .select(*day, "theory_workplace")
    )
    came = taps.select(*day).distinct().withColumn("_came", F.lit(1))
    home = sites.select(F.col("workplace_code").alias("theory_workplace"), "region")
    return (
        owed.join(came.hint("merge"), day, "left")
        .groupBy("theory_workplace")
        .agg(F.count(F.lit(1)).alias("owed_days"), F.count("_came").alias("met_days"))
        .join(home, "theory_workplace")
        .groupBy("region")
        .agg(F.sum("owed_days").alias("owed_days"), F.sum("met_days").alias("met_days"))
        .withColumn("realised_rate", F.round(ratio(F.col("met_days"), F.col("owed_days")), 4))
    )


def headlines(layer: MetricLayer, names: Iterable[str] = tuple(METRICS)) -> DataFrame:
    """One value per metric: its mean over weeks (or its only grain), with no dimensions."""
    parts = [
        layer.evaluate(n, (), METRICS[n].headline_grain)
        .agg(F.round(F.avg(n), 4).alias("value"))
        .select(F.lit(n).alias("metric"), F.lit(METRICS[n].headline_grain).alias("grain"), "value")
        for n in names
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

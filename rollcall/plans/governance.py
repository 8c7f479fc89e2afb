"""Measure audit: metrics and the columns of the governed facts must account for each other."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.plans.metrics import ATTENDANCE, CAPACITY, METRICS, Metric

# Columns of the governed facts that are keys or dimensions.
NOT_MEASURES = (
    "local_date",
    "iso_year_week",
    "workplace_code",
    "city",
    "region",
    "country",
    "dept_l1",
    "dept_l2",
    "dept_l3",
    "dept_l4",
    "tower",
    "floor",
    "local_hour",
    "is_weekend",
    "is_china_region",
    "required_days_per_week",
)


@dataclass(frozen=True)
class Waiver:
    columns: tuple[str, ...]
    owner: str
    reason: str


WAIVERS = (
    Waiver(
        tuple(
            f"{ATTENDANCE}.{c}"
            for c in (
                "leave_days",
                "travel_days",
                "assignment_days",
                "non_office_days",
                "post_exit_days",
                "pre_hire_days",
                "no_show_days",
                "employee_days",
            )
        ),
        "workplace-analytics",
        "Day counts by state: reports read them beside a rate, so no metric of its own is kept up.",
    ),
    Waiver(
        (
            f"{ATTENDANCE}.avg_span_minutes",
            f"{ATTENDANCE}.late_reported_tap_days",
            f"{CAPACITY}.departments_present",
        ),
        "platform-engineering",
        "Only the checks on late and odd taps use it.",
    ),
    Waiver(
        (f"{CAPACITY}.net_workstation_area_sqm",),
        "space-planning",
        "Comes from the site table and doesn't change with the day.",
    ),
)

_CLAIM = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("claimed_by", T.StringType()),
    ]
)
_WAIVED = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("owner", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)


def profile(facts: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, non-null values and range of every column, from one aggregation per fact."""
    parts = [_profile(model, fact) for model, fact in facts.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _profile(model: str, fact: DataFrame) -> DataFrame:
    numeric = {f.name for f in fact.schema if isinstance(f.dataType, T.NumericType)}

    def edge(fn, name: str) -> Column:
        return fn(name).cast("double") if name in numeric else F.lit(None).cast("double")

    stats = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(name in numeric).alias("is_numeric"),
            F.count(name).alias("non_null"),
            edge(F.min, name).alias("lowest"),
            edge(F.max, name).alias("highest"),
        )
        for name in fact.columns
    ]
    return fact.agg(F.count(F.lit(1)).alias("rows"), F.array(*stats).alias("stats")).select(
        F.lit(model).alias("model"), "rows", F.inline("stats")
    )


def claims(spark: SparkSession, metrics: Iterable[Metric] = METRICS.values()) -> DataFrame:
    rows = [(*c.partition(".")[::2], m.name) for m in metrics for c in m.claims]
    return spark.createDataFrame(rows, _CLAIM)


def waivers(spark: SparkSession, entries: Iterable[Waiver] = WAIVERS) -> DataFrame:
    rows = [(*c.partition(".")[::2], w.owner, w.reason) for w in entries for c in w.columns]
    return spark.createDataFrame(rows, _WAIVED)


def _stated(column: str) -> Column:
    return F.trim(F.coalesce(column, F.lit(""))) != ""


def audit_measures(profiled: DataFrame, claimed: DataFrame, waived: DataFrame) -> DataFrame:
    """Every numeric measure with its profile and whether a metric or a waiver covers it."""
    key = ["model", "column"]
    by_metric = claimed.groupBy(*key).agg(F.count(F.lit(1)).alias("claims"))
    excused = waived.where(_stated("owner") & _stated("reason")).select(*key).distinct()
    measures = profiled.where("is_numeric").where(~F.col("column").isin(*NOT_MEASURES))
    return (
        measures.join(by_metric, key, "left")
        .join(excused.withColumn("_waived", F.lit(True)), key, "left")
        .select(
            *key,
            "rows",
            "non_null",
            "lowest",
            "highest",
            F.coalesce("claims", F.lit(0)).alias("claims"),
            F.when(F.col("claims") > 0, "claimed")
            .when(F.col("_waived"), "waived")
            .otherwise("unclaimed")
            .alias("cover"),
        )
    )


def audit_findings(profiled: DataFrame, claimed: DataFrame, waived: DataFrame) -> DataFrame:
    """(finding, model, column) for everything that breaks the agreement; empty when sound."""
    key = ["model", "column"]
    known_model = profiled.select("model").distinct()
    malformed = F.coalesce(F.col("column"), F.lit("")) == ""

    def found(name: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(name).alias("finding"), *key).distinct()

    proper = claimed.where(~malformed)
    in_models = proper.join(known_model, "model", "left_semi")
    parts = [
        found("malformed_claim", claimed.where(malformed)),
        found("unknown_model", proper.join(known_model, "model", "left_anti")),
        found("missing_column", in_models.join(profiled, key, "left_anti")),
        found("waiver_without_reason", waived.where(~_stated("reason"))),
        found("waiver_without_owner", waived.where(_stated("reason") & ~_stated("owner"))),
        found("stale_waiver", waived.join(profiled, key, "left_anti")),
        found(
            "unclaimed_measure",
            audit_measures(profiled, claimed, waived).where("cover = 'unclaimed'"),
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

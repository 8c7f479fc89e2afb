"""Scoring of check results: the expected-failure ledger, status counts and defect recall."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.measures import label


@dataclass(frozen=True)
class Expected:
    """A failure that is known, owned and due for review."""

    check: str
    owner: str
    reason: str
    review_by: str


LEDGER = (
    Expected(
        "active_after_termination",
        "workplace-analytics",
        "Leavers planted with an active status for some days after their exit.",
        "2025-09-30",
    ),
    Expected(
        "snapshot_before_hire_date",
        "workplace-analytics",
        "Snapshot rows planted as active before the hire date.",
        "2025-09-30",
    ),
    Expected(
        "tap_after_termination",
        "security-operations",
        "Badges planted in use beyond the grace period.",
        "2025-08-31",
    ),
    Expected(
        "missing_workplace_timezone",
        "space-planning",
        "Sites planted without a time zone, to exercise the UTC fallback.",
        "2025-09-30",
    ),
)

# Defect class, manifest key, check that must find it, and which number of the
# check counts it ("value" or a detail).
DEFECTS = (
    (
        "leavers still reported active",
        "hr_resigned_still_active_employees",
        "active_after_termination",
        "employees",
    ),
    (
        "snapshot rows before the hire date",
        "hr_rows_before_hire_date",
        "snapshot_before_hire_date",
        "value",
    ),
    (
        "sites without a time zone",
        "workplace_null_timezone_workplaces",
        "missing_workplace_timezone",
        "value",
    ),
    (
        "people badging after termination",
        "tap_after_termination_employees",
        "tap_after_termination",
        "employees_after_termination_any",
    ),
)

RANK = {"pass": 0, "warn": 1, "fail": 2}


def ledger(spark: SparkSession, entries: Iterable[Expected] = LEDGER) -> DataFrame:
    rows = [(x.check, x.owner, x.reason, x.review_by) for x in entries]
    return spark.createDataFrame(
        rows, "name string, owner string, reason string, review_by string"
    ).withColumn("review_by", F.col("review_by").cast("date"))


def scorecard(results: DataFrame, expected: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per check or ledger entry with its verdict.

    Verdicts: `unexpected` (failed, not in the ledger), `expected` (failed, in the ledger),
    `stale` (in the ledger but no longer failing), `unknown` (ledger names no such check), `ok`.
    """
    as_of = F.current_date() if as_of is None else as_of
    failed, listed = F.col("status") == "fail", F.col("owner").isNotNull()
    verdict = (
        F.when(F.col("status").isNull(), "unknown")
        .when(failed & listed, "expected")
        .when(failed, "unexpected")
        .when(listed, "stale")
        .otherwise("ok")
    )
    return results.join(expected, "name", "full").select(
        "name",
        "category",
        "status",
        "value",
        "threshold",
        verdict.alias("verdict"),
        "owner",
        "review_by",
        (F.col("review_by") < as_of).alias("is_overdue"),
    )


def summary(card: DataFrame) -> DataFrame:
    """Counts per status and verdict, the worst status, and whether the run passes."""
    rank = label(F.col("status"), RANK)
    verdicts = ("unexpected", "expected", "stale")
    counted = card.agg(
        *(F.count_if(F.col("status") == s).alias(f"n_{s}") for s in RANK),
        *(F.count_if(F.col("verdict") == v).alias(v) for v in verdicts),
        F.coalesce(F.max(rank), F.lit(0)).alias("_worst"),
    )
    return counted.select(
        *(f"n_{s}" for s in RANK),
        *verdicts,
        label(F.col("_worst"), {r: s for s, r in RANK.items()}).alias("worst"),
        ((F.col("unexpected") == 0) & (F.col("stale") == 0)).alias("passed"),
    )


def by_category(card: DataFrame) -> DataFrame:
    return (
        card.where("status IS NOT NULL")
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("checks"),
            *(F.count_if(F.col("status") == s).alias(f"n_{s}") for s in RANK),
        )
    )


def recall(results: DataFrame, manifest: DataFrame) -> DataFrame:
    """Planted against detected, per defect class. `manifest` holds (key, value) rows."""
    spark = results.sparkSession
    classes = spark.createDataFrame(
        DEFECTS, "defect string, key string, detected_by string, measure string"
    )
    numbers = results.select(
        F.col("name").alias("detected_by"),
        F.inline(
            F.map_entries(F.map_concat("details", F.create_map(F.lit("value"), F.col("value"))))
        ).alias("measure", "detected"),
    )
    injected = F.coalesce(F.col("value"), F.lit(0.0)).cast("bigint")
    detected = F.col("detected").cast("bigint")
    return (
        classes.join(manifest, "key", "left")
        .join(numbers, ["detected_by", "measure"], "left")
        .select(
            "defect",
            injected.alias("injected"),
            "detected_by",
            detected.alias("detected"),
            F.coalesce(detected > 0, F.lit(False)).alias("caught"),
            F.coalesce(detected == injected, F.lit(False)).alias("exact"),
        )
    )

"""Closed date intervals: expansion to days, one pick per key, and day spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expand_days(df: DataFrame, start: str, end: str, out: str) -> DataFrame:
    """One row per day of each closed interval; a reversed or open interval gives none."""
    days = F.sequence(F.col(start), F.col(end))
    return df.where(F.col(start) <= F.col(end)).withColumn(out, F.explode(days))


def first_per_key(
    df: DataFrame, keys: list[str], order: list[Column], keep: list[str]
) -> DataFrame:
    """The row that sorts first (nulls last) within each key.

    An aggregate, not a row number: each task passes on one candidate per key, so overlapping
    rows of a heavy key never meet in one task.
    """
    ranked = [part for c in order for part in (c.isNull(), c)]
    names = [f"_{i}" for i in range(len(ranked))]
    best = F.min(F.struct(*(c.alias(n) for c, n in zip(ranked, names)), *keep)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *(f"_best.{c}" for c in keep))


def day_bounds(df: DataFrame, day: str) -> tuple[Column, Column]:
    """First and last day of a frame as scalar columns, evaluated inside the query using them."""
    bounds = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return bounds.select("lo").scalar(), bounds.select("hi").scalar()

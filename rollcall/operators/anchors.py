"""Assignment of events to the day of the entry they follow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def anchor_day(
    events: DataFrame,
    entity: str,
    ts: str,
    is_entry: Column,
    clock_day: Column,
    out: str,
    max_age_days: int | None = None,
) -> DataFrame:
    """Give each event the clock day of the latest entry at or before it, else its own.

    `clock_day` must never decrease with `ts`. An entry then simply has its own clock day, and
    for exits the running look-back needs no window over events: one row per (entity, clock
    day) says when that day's first entry was and which earlier day had one. That table is
    pre-aggregated before its shuffle and holds at most one row per entity and day, however
    many events a single entity has. Only exits are shuffled to meet it, by (entity, day), and
    a heavy pair can still be split by the adaptive skew join because the other side has one
    row for it. Entries come before exits at equal times.

    The days table grows with the events, hence the merge hint: it is never broadcast on the
    strength of an estimate. `events` is read three times, so pass a stored table rather than a long plan.
    `max_age_days` stops an exit from reaching back further; the default has no such limit.
    """
    events = events.withColumn("_day", clock_day).withColumn(
        "_entry", F.coalesce(is_entry, F.lit(False))
    )
    first_entry = F.min(F.when(F.col("_entry"), F.col(ts)))
    earlier = W.partitionBy(entity).orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
    days = (
        events.groupBy(entity, "_day")
        .agg(first_entry.alias("_first"))
        .withColumn(
            "_before",
            F.last(F.when(F.col("_first").isNotNull(), F.col("_day")), ignorenulls=True).over(
                earlier
            ),
        )
    )
    before = F.col("_before")
    if max_age_days is not None:
        before = F.when(F.date_diff(F.col("_day"), before) <= max_age_days, before)
    anchor = F.when(F.col("_first") <= F.col(ts), F.col("_day")).otherwise(
        F.coalesce(before, F.col("_day"))
    )
    entries = events.where("_entry").withColumn(out, F.col("_day"))
    exits = (
        events.where("NOT _entry")
        .join(days.hint("merge"), [entity, "_day"], "left")
        .withColumn(out, anchor)
        .drop("_first", "_before")
    )
    return entries.unionByName(exits).drop("_day", "_entry")

"""Removal of repeated events that follow one another within a time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.functions.times import epoch_second, seconds_crossed


def drop_repeats(
    df: DataFrame,
    keys: list[str],
    ts: str,
    window_seconds: int,
    tie_break: tuple[str, ...] = (),
    slice_seconds: int = 3600,
) -> DataFrame:
    """Drop every event at most `window_seconds` after the previous event of the same `keys`.

    The previous event is the previous *raw* one, so a chain of events collapses to its first.

    A window over `keys` alone would put all events of one key into one task. Time is therefore
    cut into slices that are part of the window key, and an event close to the end of its slice
    is echoed into the slice(s) its window reaches. The echo is only ever looked back at, so
    the answer is the same as for the uncut key, a heavy key spreads over many tasks, and the
    copies are window/slice of the rows (2.5 % by default).
    """
    second = epoch_second(F.col(ts))
    own = F.floor(second / slice_seconds)
    reach = F.floor((second + window_seconds) / slice_seconds)
    sliced = df.select(
        "*", own.alias("_own"), F.explode(F.sequence(own, reach)).alias("_slice")
    )
    within = W.partitionBy(*keys, "_slice").orderBy(ts, *tie_break)
    return (
        sliced.withColumn("_previous", F.lag(ts).over(within))
        .where(
            (F.col("_slice") == F.col("_own"))
            & (
                F.col("_previous").isNull()
                | (seconds_crossed(F.col("_previous"), F.col(ts)) > window_seconds)
            )
        )
        .drop("_own", "_slice", "_previous")
    )

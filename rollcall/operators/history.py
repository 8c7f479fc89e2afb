"""Validity intervals from repeated full snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def row_hash(columns: list[str], null_safe: list[str]) -> Column:
    """Change hash over `columns`; those in `null_safe` keep their place when null."""
    parts = [
        F.coalesce(F.col(c), F.lit("<null>")) if c in null_safe else F.col(c) for c in columns
    ]
    return F.md5(F.concat_ws("|", *parts))


def versions(
    df: DataFrame, key: str, as_of: str, fingerprint: Column, carried: list[str], tasks: int | None = None
) -> DataFrame:
    """Collapse consecutive snapshots with an equal fingerprint into numbered versions.

    A gap in the dates does not end a version. Carried columns take their latest value.
    One key has one row per snapshot day (the grain of the feed), which bounds a window
    partition by the number of days kept. Every step below is keyed by `key` first, so the
    plan has a single exchange and a single sort: the last row of a version has its carried columns, and what else is
    known of the version runs along to it, so rows in between are dropped and nothing is grouped. It has the session's number of tasks, which adaptive execution
    lowers by compressed bytes, unless `tasks` says how many the sort of the wide rows needs.
    """
    if tasks is not None:
        df = df.repartition(tasks, key)
    # Rows of one day, should there be several, are in the order in which the latest of them is found.
    by_day = W.partitionBy(key).orderBy(as_of, *carried)
    so_far = by_day.rowsBetween(W.unboundedPreceding, W.currentRow)
    place = F.row_number().over(by_day)
    print_ = F.col("_print")
    marked = df.select(key, as_of, *carried, fingerprint.alias("_print")).select(
        key,
        as_of,
        *carried,
        place.alias("_place"),
        F.lag(as_of).over(by_day).isNull().alias("_undated"),
        ((place == 1) | ~F.lag(print_).over(by_day).eqNullSafe(print_)).alias("_starts"),
        (F.lead(F.lit(True)).over(by_day).isNull() | ~F.lead(print_).over(by_day).eqNullSafe(print_)).alias("_ends"),
    )
    begins = F.when(F.col("_starts") | F.col("_undated"), F.col(as_of))
    ends = marked.select(
        "*",
        F.count_if("_starts").over(so_far).alias("version_number"),
        F.max(F.when(F.col("_starts"), F.col("_place"))).over(so_far).alias("_start"),
        F.max(begins).over(so_far).alias("valid_from"),
    ).where("_ends")
    newest = F.max(as_of).over(by_day.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return ends.select(
        key,
        "version_number",
        "valid_from",
        F.col(as_of).alias("valid_to"),
        (F.col("_place") - F.col("_start") + 1).cast("bigint").alias("snapshot_days"),
        (F.col(as_of) == newest).alias("is_current"),
        *carried,
    )

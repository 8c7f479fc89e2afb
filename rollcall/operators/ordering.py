"""Places of rows in a globally sorted frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.sources.store import TableStore


def numbered(ordered: DataFrame, store: TableStore, name: str, out: str = "position") -> DataFrame:
    """The rows of a sorted frame with their places, from 1.

    A global sort leaves ranges in partitions, so a row's place is the number of rows in the partitions before its own
    plus its place there. The sorted rows are stored once with both numbers; what is added up is one row per partition.
    """
    at = F.monotonically_increasing_id()
    rows = store.put(name, ordered.withColumns({"_part": F.shiftright(at, 33), "_place": at.bitwiseAND((1 << 33) - 1)}))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    starts = starts.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = (F.col("_start") + F.col("_place") + 1).alias(out)
    return rows.join(starts, "_part").select(*ordered.columns, place)

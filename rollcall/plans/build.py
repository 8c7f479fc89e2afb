"""From landed files to governed tables, stopping at the first broken promise."""

from __future__ import annotations

from pyspark.sql import SparkSession

from rollcall.plans.estate import SHARED, Estate
from rollcall.plans.rules import hold_gates
from rollcall.settings import Settings
from rollcall.sources.feeds import load_feeds
from rollcall.sources.store import TableStore


def build(
    spark: SparkSession,
    root: str,
    settings: Settings | None = None,
    store: TableStore | None = None,
) -> Estate:
    """Contracts over the files below `root`, then the shared tables, then the blocking gates."""
    estate = Estate(spark, load_feeds(spark, root), settings, store).settle(*SHARED)
    hold_gates(estate)
    return estate

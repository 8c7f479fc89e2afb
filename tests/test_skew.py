"""A third of all taps on one badge: same answer, and no task gets that third."""

from __future__ import annotations

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.functions import times
from rollcall.plans import presence, staging


@pytest.fixture(scope="module")
def taps(spark):
    n = 300_000
    second = (F.col("id") * 7919) % (30 * 86400)
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("E"), (F.col("id") % 997).cast("string"))).alias(
            "emp_id"
        ),
        F.concat(F.lit("W"), (F.col("id") % 4).cast("string")).alias("workplace_code"),
        F.lit("A").alias("tower"),
        F.lit(1).alias("floor"),
        (F.expr("timestamp_ntz'2024-03-01'") + F.make_dt_interval(secs=second)).alias("tap_ts_utc"),
        F.when(F.col("id") % 5 < 2, "out").otherwise("in").alias("direction"),
        F.concat(F.lit("D"), (F.col("id") % 2).cast("string")).alias("device_id"),
        F.expr("date'2024-03-01'").alias("ingested_date"),
    )


@pytest.fixture(scope="module")
def sites(spark):
    zones = ["UTC", "Asia/Shanghai", "Europe/Berlin", "America/New_York"]
    rows = [(f"W{i}", z, "c", "CN", False) for i, z in enumerate(zones)]
    return spark.createDataFrame(
        rows, "workplace_code string, timezone string, city string, region string, has_missing_timezone boolean"
    )


@pytest.fixture(scope="module")
def kept(spark, estate, taps, sites):
    return estate.store.put("skewed_taps", staging.kept_taps(taps, sites), ("direction",))


def test_repeats_equal_the_plain_window(taps, kept):
    plain = W.partitionBy("emp_id", "device_id", "direction").orderBy(
        "tap_ts_utc", "workplace_code", "tower", "floor", "ingested_date"
    )
    previous = F.lag("tap_ts_utc").over(plain)
    want = taps.withColumn("p", previous).where(
        F.col("p").isNull() | (times.seconds_crossed(F.col("p"), F.col("tap_ts_utc")) > 90)
    )
    columns = taps.columns
    assert 0 < kept.count() < taps.count()
    assert kept.select(columns).exceptAll(want.select(columns)).isEmpty()
    assert want.select(columns).exceptAll(kept.select(columns)).isEmpty()


def test_business_days_equal_the_plain_window(kept, sites):
    local = staging.localise(kept, sites).withColumn("clock", times.cutover_date(F.col("tap_ts_local"), 4))
    order = W.partitionBy("emp_id").orderBy("tap_ts_local", "direction").rowsBetween(W.unboundedPreceding, 0)
    anchor = F.last(F.when(F.col("direction") == "in", F.col("clock")), ignorenulls=True).over(order)
    want = local.select("emp_id", "tap_ts_local", "direction", F.coalesce(anchor, "clock").alias("business_date"))
    got = staging.badge_taps(kept, sites).select(want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert presence.tap_day(staging.badge_taps(kept, sites)).where("emp_id = 'hot'").count() <= 32


def test_no_task_holds_the_heavy_badge(spark, taps, sites):
    settings = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        per_task = (
            staging.kept_taps(taps, sites).groupBy(F.spark_partition_id().alias("task")).count().collect()
        )
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = [r["count"] for r in per_task]
    assert len(sizes) == 24 and max(sizes) < 2 * sum(sizes) / len(sizes)

"""Times the headline queries from source files to full result; prints one JSON line.

Nothing is shared between queries: the session's stored tables are dropped before each run, so each derives the feeds
and builds every model it needs. The line ends with the number of runs behind each figure.
Reads BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS (the median of that many runs is reported;
once BENCH_SECONDS have passed, each query left runs once).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from rollcall.catalog.queries import MODELS
from rollcall.sources.store import SessionStore

HEADLINES = (
    "q_taps_deduped",
    "q_taps_business_day",
    "q_tap_day",
    "q_floor_hourly",
    "q_scd2",
    "q_leave_days",
    "q_travel_days",
    "q_employee_day",
    "q_attendance_daily_fact",
    "q_capacity_daily_fact",
    "q_metric_attendance_rate",
    "q_metric_seat_demand_absolute",
    "q_metric_waste_ratio",
    "q_dq_psi",
    "q_dq_reconcile",
    "q_realised_rates",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rollcall-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    most = float(os.environ.get("BENCH_SECONDS", "420"))
    wanted = sys.argv[1:] or HEADLINES
    spark = session(cpus)
    for name in ("q_schedule", "q_tap_day"):
        MODELS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    started = time.perf_counter()
    seconds, counts = {}, {}
    for name in wanted:
        taken = []
        for _ in range(runs):
            SessionStore.of(spark).drop()
            begin = time.perf_counter()
            MODELS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begin)
            if time.perf_counter() - started > most:
                break
        seconds[name], counts[name] = round(statistics.median(taken), 3), len(taken)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "runs": counts,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

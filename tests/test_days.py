"""Day ranges through the model graph, and refresh of single days."""

from __future__ import annotations

import os
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from rollcall.catalog.oracle_queries import ORACLES
from rollcall.catalog.queries import TWO_DAYS, _landed
from rollcall.plans.estate import DAILY, Estate
from rollcall.plans.increments import affected_days, build_daily, refresh
from rollcall.plans.metrics import MetricLayer
from rollcall.settings import Settings
from rollcall.sources.days import DayRange, DayTables, LandedFeeds, parts, spans
from rollcall.sources.feeds import write_feed
from rollcall.sources.store import TableStore

WEEK = DayRange(date(2024, 1, 10), date(2024, 1, 16))


@pytest.fixture(scope="module")
def landed(spark, sf_dir):
    return _landed(spark, sf_dir)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_spans_close_small_gaps():
    days = [date(2024, 1, d) for d in (9, 1, 2, 2, 5)]
    assert spans(days) == [DayRange(days[1], days[2]), DayRange(days[4], days[4]), DayRange(days[0], days[0])]
    assert spans(days, 2) == [DayRange(days[1], days[4]), DayRange(days[0], days[0])] and spans([]) == []
    assert spans(days, 3) == [DayRange(days[1], days[0])]


def test_a_week_reads_its_partitions_only(spark, landed):
    e = Estate(spark, LandedFeeds(spark, landed), TWO_DAYS, days=WEEK)
    plan = physical(e["int_employee_day"])
    assert "PartitionFilters: [isnotnull(dt" in plan and "(dt#" in plan
    raw = physical(e._taps())
    assert "2024-01-06" in raw and "2024-01-19" in raw  # two days and one for zones; one more back for re-swipes
    stored = DayTables(spark, f"{TableStore(spark).root}/t")
    stored.write("fct_attendance_daily", e["fct_attendance_daily"])
    facts = {"fct_attendance_daily": stored.read("fct_attendance_daily", DayRange(WEEK.first, WEEK.first))}
    rate = MetricLayer(facts).evaluate("attendance_rate", ["region"], "week")
    assert "PartitionFilters: [isnotnull(local_date" in physical(rate) and rate.count()


@pytest.mark.parametrize("settings", [TWO_DAYS, Settings()], ids=["two days", "any age"])
def test_a_range_has_the_rows_of_the_whole(spark, landed, settings):
    feeds = LandedFeeds(spark, landed)
    whole = Estate(spark, feeds, settings).settle("stg_badge_taps", "int_employee_day")
    part = Estate(spark, feeds, settings, days=WEEK).settle("stg_badge_taps", "int_employee_day")
    for name in DAILY:
        want = whole[name].where(WEEK.holds("local_date"))
        assert want.count() == part[name].count() > 0
        assert want.exceptAll(part[name]).isEmpty()
    assert part["int_employee_scd2"].count() == whole["int_employee_scd2"].count()


def test_the_age_limit_matters_and_is_in_the_sql(spark, landed):
    assert "clock_day - business_date > 2" in ORACLES["q_day_refresh"] and "clock_day - business_date > 2" in ORACLES["q_day_range_rate"]
    feeds = LandedFeeds(spark, landed)
    limited, free = (Estate(spark, feeds, s)["stg_badge_taps"].groupBy("business_date").count() for s in (TWO_DAYS, Settings()))
    assert not limited.exceptAll(free).isEmpty()


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_refresh_rebuilds_just_the_days_late_rows_name(spark, estate, tmp_path):
    root, tables = str(tmp_path / "feeds"), DayTables(spark, str(tmp_path / "daily"))
    feeds = LandedFeeds(spark, root)
    for name in feeds:
        write_feed(estate[name], root, name)
    tapped = F.col("tap_ts_utc").cast("date")
    late = tapped == F.lit(date(2024, 1, 20))
    write_feed(estate["badge_taps"].where(~late), root, "badge_taps")
    build_daily(spark, root, tables, TWO_DAYS)
    before = {n: files(f"{tables.root}/{n}") for n in DAILY}
    stale = tables.read("fct_attendance_daily").agg(F.sum("attendance_daily")).first()[0]
    write_feed(estate["badge_taps"].where(late), root, "badge_taps", replace_days_only=True)
    changes = {"badge_taps": estate["badge_taps"].where(late)}
    assert refresh(spark, root, tables, changes, TWO_DAYS) == [DayRange(date(2024, 1, 17), date(2024, 1, 24))]
    whole = Estate(spark, feeds, TWO_DAYS).settle("stg_badge_taps", "int_employee_day")
    for name in DAILY:
        got = tables.read(name)
        assert got.columns == whole[name].columns
        assert got.exceptAll(whole[name]).isEmpty() and whole[name].exceptAll(got).isEmpty()
        after = files(f"{tables.root}/{name}")
        rebuilt = {p.split("local_date=")[1][:10] for p in before[name] - after}
        assert rebuilt and rebuilt <= {f"2024-01-{d}" for d in range(17, 25)}
    assert tables.read("fct_attendance_daily").agg(F.sum("attendance_daily")).first()[0] > stale


def test_a_day_without_rows_loses_its_partition(spark, tmp_path):
    tables, days = DayTables(spark, str(tmp_path)), DayRange(date(2024, 1, 1), date(2024, 1, 3))
    df = spark.createDataFrame([(d, 1) for d in days], "local_date date, n int")
    tables.write("t", df)
    tables.replace("t", df.where("local_date <> '2024-01-02'").withColumn("n", F.lit(2)), DayRange(days.first, date(2024, 1, 2)))
    assert sorted((r.local_date.day, r.n) for r in tables.read("t").collect()) == [(1, 2), (3, 1)]
    assert DayTables(spark, str(tmp_path)).read("t").count() == 2


def test_changes_of_feeds_without_days_affect_every_day(spark, estate):
    count = lambda changes, s=TWO_DAYS: affected_days(changes, s, estate).count()
    assert count({"dept_schedule": estate["dept_schedule"]}) == count({"badge_taps": estate["badge_taps"].limit(1)}, Settings()) == 32
    assert count({"dept_schedule": estate["dept_schedule"].limit(0)}) == count({"badge_taps": estate["badge_taps"].limit(0)}) == 0
    assert count({"hr_employee_snapshot": estate["hr_employee_snapshot"].where("snapshot_date = '2024-01-03'")}) == 1


def test_daily_tables_are_written_once(spark, landed, tmp_path, monkeypatch):
    """The facts read the employee-days where they were written by day; no second copy goes to the store."""
    put, stored, written = TableStore.put, [], []
    monkeypatch.setattr(TableStore, "put", lambda self, name, *a: (stored.append(name), put(self, name, *a))[1])
    shaped = DayTables._shaped
    monkeypatch.setattr(DayTables, "_shaped", lambda self, df: (written.append(df.inputFiles()), shaped(self, df))[1])
    tables = DayTables(spark, str(tmp_path))
    build_daily(spark, landed, tables, TWO_DAYS)
    changes = {"hr_employee_snapshot": LandedFeeds(spark, landed).between("hr_employee_snapshot", WEEK)}
    assert refresh(spark, landed, tables, changes, TWO_DAYS) == [WEEK]
    assert "int_employee_day" not in stored and "kept_taps" in stored
    assert len(written) == 2 * len(DAILY)
    for read in (written[1], written[2], written[5], written[6]):  # both facts of employee-days, twice
        assert any(f"{tmp_path}/int_employee_day/" in file for file in read)


def test_parts_hold_so_many_rows_or_a_day():
    d = lambda n: date(2024, 1, n)
    rows = {d(2): 3, d(3): 3, d(5): 9, d(6): 1, d(9): 2}
    assert parts(DayRange(d(1), d(10)), rows, 6) == [DayRange(d(1), d(4)), DayRange(d(5), d(5)), DayRange(d(6), d(10))]
    assert parts(DayRange(d(1), d(4)), rows, 6) == [DayRange(d(1), d(4))]
    assert parts(DayRange(d(4), d(6)), rows, 1) == [DayRange(d(4), d(5)), DayRange(d(6), d(6))]


def test_daily_tables_in_parts_have_the_rows_of_the_whole(spark, estate, tmp_path, monkeypatch):
    """Parts of four days, shuffled by day, and shorter ones, written as they are; rows without a day are a part too."""
    root, feeds = str(tmp_path / "feeds"), LandedFeeds(spark, str(tmp_path / "feeds"))
    for name in feeds:
        write_feed(estate[name], root, name)
    hr = estate["hr_employee_snapshot"].where("snapshot_date <= '2024-01-10'")
    undated = hr.where("emp_id IN ('E5', 'E6')").withColumn("snapshot_date", F.lit(None).cast("date"))
    write_feed(hr.unionByName(undated).unionByName(hr.where("emp_id = 'E7'")), root, "hr_employee_snapshot")
    late = F.col("tap_ts_utc").cast("date") == F.lit(date(2024, 1, 6))
    changes = {"badge_taps": estate["badge_taps"].where(late)}
    monkeypatch.setattr(DayTables, "FEW", 3)
    written, add, replace = [], DayTables.write, DayTables.replace
    monkeypatch.setattr(DayTables, "write", lambda self, name, *a, **k: (written.append(name), add(self, name, *a, **k))[1])
    monkeypatch.setattr(DayTables, "replace", lambda self, name, *a: (written.append(name), replace(self, name, *a))[1])
    tables, counts = {}, {}
    for most in (20_000_000, 700):
        monkeypatch.setattr("rollcall.plans.estate.ROWS_AT_ONCE", most)
        tables[most] = DayTables(spark, str(tmp_path / f"daily_{most}"))
        write_feed(estate["badge_taps"].where(~late), root, "badge_taps")
        build_daily(spark, root, tables[most], TWO_DAYS)
        write_feed(estate["badge_taps"].where(late), root, "badge_taps", replace_days_only=True)
        refresh(spark, root, tables[most], changes, TWO_DAYS)
        counts[most] = [written.count(n) for n in DAILY]
        written.clear()
    assert counts[20_000_000] == [2, 2, 2, 2] and counts[700] == [6, 6, 2, 2]
    for name in DAILY:
        whole, in_parts = (t.read(name) for t in tables.values())
        assert whole.count() and whole.exceptAll(in_parts).isEmpty() and in_parts.exceptAll(whole).isEmpty()
    assert tables[700].read("int_employee_day").where("local_date IS NULL").count() == undated.count() > 0


def test_written_tables_leave_no_shuffle_files(spark, estate, tmp_path):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffled():
        return {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}

    before, tables = shuffled(), DayTables(spark, str(tmp_path / "daily"))
    df = estate["int_employee_day"].groupBy("local_date").count()
    tables.write("t", df)
    tables.replace("t", df, WEEK)
    write_feed(estate["badge_taps"], str(tmp_path), "badge_taps")
    TableStore(spark).put("t", df)
    until = time.time() + 10  # executors delete the files on their own
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before

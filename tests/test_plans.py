"""Physical plans: what must and must not be in them at scale."""

from __future__ import annotations

import math
import re

import pytest

from rollcall.operators.repeats import drop_repeats
from rollcall.plans import marts, presence, staging
from rollcall.plans.estate import EMPLOYEE_DAY_READ
from rollcall.sources import store


def physical(df) -> str:
    """The initial plan, without the adaptive final one."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def without_broadcast(spark):
    """As if no side were small enough."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def table(spark, estate, name):
    """A stored copy, so a plan shows the operator under test only."""
    return estate.store.put(f"plan_{name}", estate[name])


@pytest.fixture(scope="module")
def stored(spark, estate):
    names = (
        "stg_hr_employee_snapshot",
        "stg_dept_schedule",
        "int_leave_days",
        "int_travel_days",
        "int_tap_day",
        "stg_city_primary_workplace",
        "badge_taps",
    )
    return {n: table(spark, estate, n) for n in names}


def test_growing_sides_are_merged_never_broadcast(stored):
    out = presence.employee_day(
        stored["stg_hr_employee_snapshot"],
        stored["stg_dept_schedule"],
        stored["int_leave_days"],
        stored["int_travel_days"],
        stored["int_tap_day"],
        stored["stg_city_primary_workplace"],
    )
    plan = physical(out)
    assert len(re.findall(r"SortMergeJoin \[emp_id", plan)) == 3
    # The policy and city tables are small files here, and only those are broadcast.
    assert plan.count("BroadcastExchange") == 2


def test_no_join_needs_a_broadcast(stored, estate, without_broadcast):
    out = presence.employee_day(
        stored["stg_hr_employee_snapshot"],
        stored["stg_dept_schedule"],
        stored["int_leave_days"],
        stored["int_travel_days"],
        stored["int_tap_day"],
        stored["stg_city_primary_workplace"],
    )
    capacity = marts.fct_workplace_capacity_daily(
        estate["int_employee_day"], estate["dim_workplace"], stored["stg_hr_employee_snapshot"], "snapshot_date"
    )
    taps = staging.badge_taps(estate["kept_taps"], estate["stg_workplace"])
    for df in (out, capacity, taps):
        plan = physical(df)
        assert "Broadcast" not in plan and "CartesianProduct" not in plan


def test_facts_have_no_cross_join(estate):
    for name in ("int_employee_day", "fct_workplace_capacity_daily", "fct_attendance_daily"):
        e = type(estate)(estate.spark, estate._feeds)
        e._tables["kept_taps"] = estate["kept_taps"]
        e._tables["stg_workplace"] = estate["stg_workplace"]
        plan = physical(e[name])
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_employee_day_is_scanned_once_per_fact(estate, stored):
    days = estate["int_employee_day"]
    capacity = marts.fct_workplace_capacity_daily(
        days, estate["dim_workplace"], stored["stg_hr_employee_snapshot"], "snapshot_date"
    )
    assert len(re.findall(r"FileScan.*expected_workplace", physical(capacity))) == 1
    attendance = marts.fct_attendance_daily(days, estate["stg_workplace"])
    plan = physical(attendance)
    assert len(re.findall(r"FileScan.*expected_workplace", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_history_has_a_single_exchange(stored):
    plan = physical(presence.employee_history(stored["stg_hr_employee_snapshot"]))
    assert plan.count("Exchange hashpartitioning") == 1


def test_history_is_dealt_by_the_rows_of_the_feeds(spark, estate, monkeypatch):
    """As many tasks as the rows ask for, still in a single exchange, which adaptive execution leaves alone."""
    monkeypatch.setattr(store, "ROWS_PER_TASK", 100)
    e = type(estate)(spark, {"hr_employee_snapshot": estate["hr_employee_snapshot"]})
    wanted = math.ceil(e.rows / 100)
    assert wanted > 8
    plan = physical(e["int_employee_scd2"])
    assert plan.count(f", {wanted}), REPARTITION_BY_NUM") == 1 and "ENSURE_REQUIREMENTS" not in plan
    assert e["int_employee_scd2"].exceptAll(estate["int_employee_scd2"]).count() == 0


def test_stored_tables_have_tasks_by_the_rows_of_the_feeds(spark, estate, monkeypatch):
    """While a table is written its shuffles go by the rows; the session's settings are back afterwards."""
    monkeypatch.setattr(store, "ROWS_PER_TASK", 100)
    e = type(estate)(spark, {n: estate[n] for n in ("hr_employee_snapshot", "workplace_dim")})
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before, seen = [spark.conf.get(k, None) for k in keys], []
    put = store.TableStore.put
    monkeypatch.setattr(store.TableStore, "put", lambda *a: (seen.append([spark.conf.get(k) for k in keys]), put(*a))[1])
    e.put("days", e["hr_employee_snapshot"])
    assert e.rows == estate["hr_employee_snapshot"].count() + estate["workplace_dim"].count()
    assert seen == [[str(math.ceil(e.rows / 100)), store.JOINED_BYTES]]
    assert [spark.conf.get(k, None) for k in keys] == before


def test_repeat_removal_has_a_single_exchange_keyed_by_slice(stored):
    taps = drop_repeats(stored["badge_taps"], staging.TAP_KEYS, "tap_ts_utc", 90)
    plan = physical(taps)
    assert plan.count("Exchange hashpartitioning") == 1
    assert re.search(r"hashpartitioning\(emp_id#\d+, device_id#\d+, direction#\d+, _slice", plan)


def test_only_exits_are_shuffled_to_their_anchor(estate):
    plan = physical(staging.badge_taps(estate["kept_taps"], estate["stg_workplace"]))
    # One of exits; of the pre-aggregated days three: to total, by employee, and to the join.
    exchanged = re.findall(r"Exchange hashpartitioning\((.*?), 8\)", plan)
    assert [re.sub(r"#\d+", "", e) for e in exchanged] == [
        "emp_id, _day",
        "emp_id, _day",
        "emp_id",
        "emp_id, _day",
    ]
    entries = plan.split("SortMergeJoin")[0]
    assert "Exchange hashpartitioning" not in entries
    assert "PartitionFilters: [coalesce((direction" in plan


def test_business_days_spread_a_heavy_badge(spark, estate):
    """No window over events is partitioned by employee alone."""
    plan = physical(staging.badge_taps(estate["kept_taps"], estate["stg_workplace"]))
    windows = re.findall(r"Window \[(.*?)\]", plan)
    assert windows and all(w.startswith("last(") for w in windows)


def test_no_python_runs_in_any_model(estate):
    for name in ("int_employee_day", "fct_workplace_capacity_daily", "int_employee_scd2"):
        e = type(estate)(estate.spark, estate._feeds)
        e._tables["kept_taps"] = estate["kept_taps"]
        e._tables["stg_workplace"] = estate["stg_workplace"]
        plan = physical(e[name])
        assert "Python" not in plan and "Pandas" not in plan


def test_the_read_employee_day_has_all_rows_and_few_columns(spark, estate, monkeypatch):
    """Queries that only count store what is read of the wide table; what isn't read is not shuffled either."""
    put, stored = store.TableStore.put, {}
    monkeypatch.setattr(store.TableStore, "put", lambda self, name, df, *a: (stored.update({name: df}), put(self, name, df, *a))[1])
    e = type(estate)(spark, estate._feeds).settle_read("int_employee_day", "fct_attendance_daily")
    whole = estate["int_employee_day"].select(*EMPLOYEE_DAY_READ)
    assert e["int_employee_day"].exceptAll(whole).isEmpty() and whole.exceptAll(e["int_employee_day"]).isEmpty()
    assert e["fct_attendance_daily"].exceptAll(estate["fct_attendance_daily"]).isEmpty()
    plan = physical(stored["int_employee_day"])
    assert "manager_id" not in plan and "badge_type" not in plan and "tower_first" not in plan

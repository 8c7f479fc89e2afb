"""Every model of the stored estate against SQL, and the cases the fixture must contain."""

from __future__ import annotations

import pytest
from compare import differences
from pyspark.sql import functions as F

from rollcall.catalog.oracle_queries import ORACLES
from rollcall.catalog.queries import MODELS, QUERIES, plain
from rollcall.plans import presence, reports, rules

MODEL_QUERIES = {
    "q_workplace_space": "stg_workplace_space",
    "q_workplace_rollup": "stg_workplace",
    "q_city_primary": "stg_city_primary_workplace",
    "q_dim_workplace": "dim_workplace",
    "q_taps_business_day": "stg_badge_taps",
    "q_tap_day": "int_tap_day",
    "q_floor_hourly": "fct_floor_presence_hourly",
    "q_hr_typed": "stg_hr_employee_snapshot",
    "q_scd2": "int_employee_scd2",
    "q_dim_employee": "dim_employee",
    "q_leave_staged": "stg_leave_requests",
    "q_leave_days": "int_leave_days",
    "q_travel_staged": "stg_travel_bookings",
    "q_travel_days": "int_travel_days",
    "q_schedule": "stg_dept_schedule",
    "q_employee_day": "int_employee_day",
    "q_dim_date": "dim_date",
    "q_attendance_daily_fact": "fct_attendance_daily",
    "q_capacity_daily_fact": "fct_workplace_capacity_daily",
}


@pytest.mark.parametrize("query", MODEL_QUERIES)
def test_model_equals_sql(estate, duck, query):
    assert differences(plain(estate[MODEL_QUERIES[query]]), duck, ORACLES[query]) is None


STANDALONE = [
    "q_taps_localised",
    "q_taps_deduped",
    "q_unknown_site_taps",
    "q_population_spine",
    "q_contract_orders",
    "q_generic_tests_retail",
    "q_metric_seat_demand_absolute",
    "q_metric_composite_no_keys",
    "q_landed_days",
    "q_landed_days_planted",
    "q_affected_days",
    "q_day_range_waste",
    "q_audit_findings",
    "q_metric_ordered",
    "q_table_tests_planted",
    "q_dq_drift_planted",
    "q_dq_samples_planted",
    "q_dq_details",
    "q_recall",
]


@pytest.mark.parametrize("query", STANDALONE)
def test_query_equals_sql(spark, sf_dir, duck, query):
    assert differences(QUERIES[query](spark, sf_dir), duck, ORACLES[query]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) == set(MODELS)


def test_entry_counts_people_per_day_and_region(spark):
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.columns == ["local_date", "tap_region", "people", "taps"]
    assert out.where("people > taps OR people < 1").count() == 0 < out.count()


def test_the_fixture_reaches_every_state(estate):
    states = {r[0] for r in estate["int_employee_day"].select("employee_day_state").distinct().collect()}
    assert states == set(presence.STATES.values())


def test_the_fixture_reaches_every_case(estate):
    taps = estate["stg_badge_taps"]
    days = estate["int_employee_day"]
    raw = estate["badge_taps"].count()
    assert estate["kept_taps"].count() < raw
    cases = {
        "missing zone": taps.where("has_missing_timezone"),
        "moved to an earlier day": taps.where("business_date < local_date"),
        "late report": taps.where("is_late_reported"),
        "overnight": taps.where("is_overnight_tap"),
        "posting": days.where("is_on_assignment AND expected_workplace <> theory_workplace"),
        "trip to an unknown city": days.where("employee_day_state = 'on_travel' AND destination_city = 'NOWHERE'"),
        "trip to another site": days.where("employee_day_state = 'on_travel' AND expected_workplace <> theory_workplace"),
        "leave during a trip": days.where("is_on_leave AND is_on_travel"),
        "leaver with leave": days.where("employee_day_state = 'post_exit' AND is_on_leave"),
        "weekend tap": days.where("employee_day_state = 'non_office_day' AND attended_flag"),
        "several sites a day": days.where("workplace_count > 1"),
        "several versions": estate["int_employee_scd2"].where("version_number > 2"),
        "people without a desk": estate["fct_workplace_capacity_daily"].where("floating_headcount > 0"),
        "retroactive leave": estate["stg_leave_requests"].where("is_retro_applied AND is_effective"),
        "reversed leave": estate["stg_leave_requests"].where("duration_days < 1 AND is_effective"),
    }
    for region in ("CN", "AMER", "EMEA", "APAC"):
        cases[region] = estate["dim_workplace"].where(F.col("region") == region)
    absent = [name for name, df in cases.items() if df.isEmpty()]
    assert absent == []


def test_termination_beats_leave(estate):
    assert estate["int_employee_day"].where("employee_day_state = 'on_leave' AND local_date > term_date").isEmpty()


def test_cascade_precedence_on_hand_written_days(spark):
    from datetime import date

    d = date(2024, 3, 5)  # a Tuesday

    def person(emp, status="active", hire=date(2024, 1, 1), term=None, city=None):
        return (d, emp, status, hire, term, "p", "FTE", "a", "a-1", "x", "y", "home", "W1", None, city)

    hr_columns = (
        "snapshot_date date, emp_id string, employment_status string, hire_date date, term_date date, "
        "badge_type string, employee_type string, dept_l1 string, dept_l2 string, dept_l3 string, "
        "dept_l4 string, base_city string, theory_workplace string, manager_id string, assignment_city string"
    )
    from rollcall.plans import staging

    people = [
        person("gone", term=date(2024, 3, 4)),
        person("last_day", term=d),
        person("new", hire=date(2024, 3, 6)),
        person("ill_on_trip"),
        person("trip_while_posted", "on_assignment", city="Oslo"),
        person("posted", "on_assignment", city="Oslo"),
        person("posted_nowhere", "on_assignment", city="Atlantis"),
        person("soon_posted", "pre_assignment", city="Oslo"),
        person("present"),
    ]
    hr = staging.hr_snapshot(spark.createDataFrame(people, hr_columns))
    schedule = spark.createDataFrame(
        [("a-1", "a", 1, True, 3, "v1")],
        "dept_l2 string, dept_l1 string, weekday int, is_scheduled_office_day boolean, "
        "required_days_per_week int, policy_version string",
    )
    leave = spark.createDataFrame(
        [("gone", d, "sick", "L1", False), ("ill_on_trip", d, "sick", "L2", False)],
        "emp_id string, leave_date date, leave_type string, leave_id string, is_retro_applied boolean",
    )
    travel = spark.createDataFrame(
        [("ill_on_trip", d, "Rome", "x", "B1", "W7"), ("trip_while_posted", d, "Rome", "x", "B2", "W7")],
        "emp_id string, travel_date date, destination_city string, origin_city string, "
        "booking_id string, destination_workplace_code string",
    )
    taps = presence.tap_day(
        spark.createDataFrame(
            [("present", "W2", "A", 1, d)],
            "emp_id string, workplace_code string, tower string, floor int, business_date date",
        ).selectExpr(
            "*",
            "timestamp_ntz'2024-03-05 09:00:00' AS tap_ts_local",
            "timestamp_ntz'2024-03-05 08:00:00' AS tap_ts_utc",
            "'c' AS city",
            "'EMEA' AS region",
            "false AS is_late_reported",
            "false AS has_missing_timezone",
            "false AS is_overnight_tap",
        )
    )
    cities = spark.createDataFrame([("Oslo", "EMEA", "W9")], "city string, region string, primary_workplace_code string")
    out = presence.employee_day(hr, schedule, leave, travel, taps, cities)
    got = {r["emp_id"]: (r["employee_day_state"], r["expected_workplace"]) for r in out.collect()}
    assert got == {
        "gone": ("post_exit", "W1"),
        "last_day": ("no_show", "W1"),
        "new": ("pre_hire", "W1"),
        "ill_on_trip": ("on_leave", "W1"),
        "trip_while_posted": ("on_travel", "W7"),
        "posted": ("on_assignment", "W9"),
        "posted_nowhere": ("on_assignment", "W1"),
        "soon_posted": ("no_show", "W1"),
        "present": ("attended", "W1"),
    }
    owed = {r["emp_id"] for r in out.where("is_attendance_expected").collect()}
    assert owed == {"last_day", "soon_posted", "present"}
    status = {r["emp_id"]: r["employment_status_effective"] for r in out.collect()}
    assert status["soon_posted"] == "pre_assignment" and status["gone"] == "terminated"


def test_rules_hold_and_gates_are_open(estate):
    assert {r["rule"]: r["violations"] for r in rules.violation_counts(estate).collect()} == {
        "attendance_within_population": 0,
        "employee_day_state_is_consistent": 0,
        "supply_identity_holds": 0,
        "workplace_attributes_agree": 0,
        "fact_grain_is_unique": 0,
    }
    rules.hold_gates(estate)


def test_rules_see_planted_violations(estate):
    facts = estate["fct_attendance_daily"].withColumn("attendance_daily", F.col("employee_days") + 1)
    assert not rules.beyond_population(facts).isEmpty()
    supply = estate["fct_workplace_capacity_daily"].withColumn("available_workstations", F.lit(-1))
    assert not rules.broken_supply(supply).isEmpty()
    days = estate["int_employee_day"].withColumn("attended_flag", F.lit(True))
    assert not rules.contradictory_states(days).isEmpty()
    space = estate["stg_workplace_space"].withColumn("city", F.concat("city", F.col("floor").cast("string")))
    assert not rules.disagreeing_floors(space).isEmpty()


def test_realised_rates_agree_with_the_employee_day(estate):
    owed = reports.realised_rates(
        estate["stg_hr_employee_snapshot"],
        estate["stg_dept_schedule"],
        estate["int_leave_days"],
        estate["int_travel_days"],
        estate["int_tap_day"],
        estate["stg_workplace"],
    ).agg(F.sum("owed_days"), F.sum("met_days")).first()
    facts = estate["fct_attendance_daily"].agg(
        F.sum("attendance_expected_days"), F.sum("attendance_expected_met")
    ).first()
    assert tuple(owed) == tuple(facts)


def test_state_composition_adds_up(estate, duck):
    days = estate["int_employee_day"]
    assert differences(plain(reports.state_composition(days)), duck, ORACLES["q_state_composition"]) is None
    assert differences(plain(reports.state_counts(days)), duck, ORACLES["q_state_counts"]) is None


def test_layer_counts(estate, duck):
    assert differences(plain(estate.layer_counts()), duck, ORACLES["q_layer_counts"]) is None


def test_supply_ladder(estate, duck):
    ladder = reports.supply_ladder(estate["fct_workplace_capacity_daily"])
    assert differences(plain(ladder), duck, ORACLES["q_supply_ladder"]) is None

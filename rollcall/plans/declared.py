"""Declared tests of the feeds, models and marts."""

from __future__ import annotations

from rollcall.operators.verify import TableTests
from rollcall.plans.presence import STATES
from rollcall.sources.contracts import (
    DIRECTIONS,
    EMPLOYEE_TYPES,
    EMPLOYMENT_STATUSES,
    LEAVE_STATUSES,
    LEAVE_TYPES,
    REGIONS,
)

SITE = ("workplace_code", "dim_workplace", "workplace_code")
DATE = ("local_date", "dim_date", "date_day")

# Which tests apply to which columns.
TABLE_TESTS: dict[str, TableTests] = {
    "hr_employee_snapshot": TableTests(
        not_null=("emp_id", "snapshot_date", "employment_status"),
        accepted=(("employment_status", EMPLOYMENT_STATUSES),),
    ),
    "badge_taps": TableTests(
        not_null=("emp_id", "tap_ts_utc"), accepted=(("direction", DIRECTIONS),)
    ),
    "leave_requests": TableTests(
        not_null=("leave_id",), unique=("leave_id",), accepted=(("status", LEAVE_STATUSES),)
    ),
    "travel_bookings": TableTests(not_null=("booking_id",), unique=("booking_id",)),
    "workplace_dim": TableTests(not_null=("workplace_code",), accepted=(("region", REGIONS),)),
    "dept_schedule": TableTests(not_null=("dept_l2",)),
    "int_employee_scd2": TableTests(
        not_null=("emp_id", "valid_from"),
        accepted=(("employment_status_reported", EMPLOYMENT_STATUSES),),
    ),
    "int_leave_days": TableTests(
        not_null=("emp_id", "leave_date"), accepted=(("leave_type", LEAVE_TYPES),)
    ),
    "int_travel_days": TableTests(not_null=("emp_id", "travel_date")),
    "int_tap_day": TableTests(
        not_null=("emp_id", "tap_workplace"),
        refers=(("tap_workplace", "stg_workplace", "workplace_code"),),
    ),
    "int_employee_day": TableTests(
        not_null=(
            "emp_id",
            "local_date",
            "expected_workplace",
            "employee_day_state",
            "state_rule_id",
        ),
        accepted=(
            ("employee_day_state", tuple(STATES.values())),
            ("state_rule_id", tuple(STATES)),
            (
                "employment_status_effective",
                ("active", "onboarding", "terminated", "on_assignment", "pre_assignment"),
            ),
        ),
        refers=(("expected_workplace", "stg_workplace", "workplace_code"),),
    ),
    "dim_date": TableTests(
        not_null=("date_day",), unique=("date_day",), accepted=(("weekday_mon0", tuple(range(7))),)
    ),
    "dim_employee": TableTests(
        not_null=("emp_id", "theory_workplace"),
        unique=("emp_id",),
        accepted=(("employee_type", EMPLOYEE_TYPES),),
        refers=(("theory_workplace", "dim_workplace", "workplace_code"),),
    ),
    "dim_workplace": TableTests(
        not_null=("workplace_code", "region", "delivered_workstations", "timezone"),
        unique=("workplace_code",),
        accepted=(("region", REGIONS),),
    ),
    "fct_attendance_daily": TableTests(
        not_null=("local_date", "workplace_code", "dept_l2", "headcount_incumbent"),
        refers=(DATE, SITE),
    ),
    "fct_workplace_capacity_daily": TableTests(
        not_null=("local_date", "workplace_code", "available_workstations"), refers=(DATE, SITE)
    ),
    "fct_floor_presence_hourly": TableTests(
        not_null=("workplace_code", "local_hour"), refers=(SITE,)
    ),
}

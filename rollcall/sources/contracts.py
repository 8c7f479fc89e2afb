"""The six feeds: columns, types, domains and grain, in one place.

The same declaration gives the read schema and the contract rules.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The closed domains of the feeds.
EMPLOYMENT_STATUSES = (
    "active",
    "onboarding",
    "resigned",
    "terminated",
    "on_assignment",
    "pre_assignment",
)
EMPLOYEE_TYPES = ("FTE", "intern", "contractor", "BPO")
LEAVE_TYPES = ("annual", "sick", "parental", "unpaid", "comp")
LEAVE_STATUSES = ("approved", "pending", "cancelled")
BOOKING_STATUSES = ("confirmed", "cancelled")
DIRECTIONS = ("in", "out")
REGIONS = ("AMER", "EMEA", "APAC", "CN")

TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    nullable: bool = False
    domain: tuple = ()
    above: float | None = None
    at_least: float | None = None
    at_most: float | None = None


@dataclass(frozen=True)
class Contract:
    feed: str
    fields: tuple[Field, ...]
    grain: tuple[str, ...] = ()
    # Feeds that land as one file per day, and the column holding that day.
    day: str | None = None
    by_name: dict[str, Field] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "by_name", {f.name: f for f in self.fields})

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, TYPES[f.type]) for f in self.fields])


def _texts(*names: str) -> tuple[Field, ...]:
    return tuple(Field(n) for n in names)


CONTRACTS: dict[str, Contract] = {
    c.feed: c
    for c in (
        Contract(
            "hr_employee_snapshot",
            (
                Field("snapshot_date", "date"),
                Field("emp_id"),
                Field("employment_status", domain=EMPLOYMENT_STATUSES),
                Field("hire_date", "date"),
                Field("term_date", "date", nullable=True),
                Field("badge_type"),
                Field("employee_type", domain=EMPLOYEE_TYPES),
                *_texts("dept_l1", "dept_l2", "dept_l3", "dept_l4"),
                Field("base_city", nullable=True),
                Field("theory_workplace"),
                Field("manager_id", nullable=True),
                Field("assignment_city", nullable=True),
            ),
            grain=("snapshot_date", "emp_id"),
            day="snapshot_date",
        ),
        Contract(
            "badge_taps",
            (
                *_texts("emp_id", "workplace_code", "tower"),
                Field("floor", "int", above=0),
                Field("tap_ts_utc", "timestamp_ntz"),
                Field("direction", domain=DIRECTIONS),
                Field("device_id"),
                Field("ingested_date", "date"),
            ),
            day="tap_ts_utc",
        ),
        Contract(
            "leave_requests",
            (
                *_texts("leave_id", "emp_id"),
                Field("leave_type", domain=LEAVE_TYPES),
                Field("start_date", "date"),
                Field("end_date", "date"),
                Field("status", domain=LEAVE_STATUSES),
                Field("applied_ts", "timestamp_ntz"),
            ),
            grain=("leave_id",),
        ),
        Contract(
            "travel_bookings",
            (
                *_texts("booking_id", "emp_id", "origin_city", "destination_city"),
                Field("depart_date", "date"),
                Field("return_date", "date"),
                Field("booking_status", domain=BOOKING_STATUSES),
                Field("hotel_flag", "boolean"),
                Field("flight_flag", "boolean"),
            ),
            grain=("booking_id",),
        ),
        Contract(
            "workplace_dim",
            (
                *_texts("workplace_code", "name", "city", "country"),
                Field("region", domain=REGIONS),
                Field("timezone", nullable=True),
                Field("tower"),
                Field("floor", "int", above=0),
                Field("delivered_workstations", "int", at_least=0),
                Field("allocated_workstations", "int", at_least=0),
                Field("free_sharing_workstations", "int", at_least=0),
                Field("net_workstation_area_sqm", "double", at_least=0),
                Field("cost_per_workstation_month", "double", above=0),
                Field("lease_expiry_date", "date"),
                Field("is_space_audited", "boolean"),
            ),
            grain=("workplace_code", "tower", "floor"),
        ),
        Contract(
            "dept_schedule",
            (
                *_texts("dept_l2", "dept_l1"),
                Field("weekday", "int", at_least=0, at_most=6),
                Field("is_scheduled_office_day", "boolean"),
                Field("required_days_per_week", "int", at_least=0, at_most=7),
                Field("policy_version"),
            ),
            grain=("dept_l2", "weekday"),
        ),
    )
}

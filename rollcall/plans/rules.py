"""Business rules over the built tables; each frame holds the rows that break one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.measures import available_desks
from rollcall.operators.verify import duplicate_keys
from rollcall.plans.estate import Estate
from rollcall.plans.quality import GRAINS


class GateClosed(ValueError):
    pass


def beyond_population(facts: DataFrame) -> DataFrame:
    """A count larger than what it is counted from: the mark of a join that multiplied rows."""
    return facts.where(
        (F.col("attendance_daily") > F.col("employee_days"))
        | (F.col("scheduled_attendance") > F.col("scheduled_office_days"))
        | (F.col("headcount_incumbent") > F.col("employee_days"))
        | (F.col("scheduled_attendance") > F.col("attendance_daily"))
    )


def contradictory_states(days: DataFrame) -> DataFrame:
    """Employee-days without a state, or with one their own flags deny."""
    needs = {
        "on_leave": F.col("is_on_leave"),
        "on_travel": F.col("is_on_travel"),
        "on_assignment": F.col("is_on_assignment"),
        "attended": F.col("attended_flag"),
        "no_show": ~F.col("attended_flag") & F.col("is_scheduled_office_day"),
        "post_exit": F.col("employment_status_effective") == "terminated",
    }
    denied = F.lit(False)
    for state, evidence in needs.items():
        denied = denied | ((F.col("employee_day_state") == state) & ~evidence)
    unset = F.col("employee_day_state").isNull() | F.col("state_rule_id").isNull()
    return days.where(unset | denied)


def repeated_grains(e: Estate) -> DataFrame:
    """(model, offending_groups) for each table whose grain does not hold."""
    parts = [
        duplicate_keys(e[table], keys)
        .agg(F.count(F.lit(1)).alias("offending_groups"))
        .select(F.lit(table).alias("model"), "offending_groups")
        for table, keys in GRAINS.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where("offending_groups > 0")


def broken_supply(facts: DataFrame, pooled_regions: tuple[str, ...] = ("CN",)) -> DataFrame:
    """Site-days where the supply definitions do not add up exactly."""
    allocated = F.col("allocated_workstations")
    offered = available_desks(
        F.col("region"), allocated, F.col("free_sharing_workstations"), pooled_regions
    )
    return facts.where(
        (F.col("delivered_workstations") != allocated + F.col("unallocated_workstations"))
        | (F.col("available_workstations") != offered)
        | (
            F.col("workstation_waste")
            != F.col("available_workstations") - F.col("attendance_actual")
        )
        | (allocated > F.col("delivered_workstations"))
    )


def disagreeing_floors(space: DataFrame) -> DataFrame:
    """Sites whose floors do not share city, region, zone or cost.

    Compared through min and max, which aggregate in place; a distinct count per attribute
    would expand every floor row four times. Missing values take no side.
    """
    shared = ("city", "region", "timezone", "cost_per_workstation_month")
    differs = F.lit(False)
    for c in shared:
        differs = differs | F.coalesce(F.col(f"lo_{c}") != F.col(f"hi_{c}"), F.lit(False))
    edges = [f(c).alias(f"{n}_{c}") for c in shared for n, f in (("lo", F.min), ("hi", F.max))]
    return space.groupBy("workplace_code").agg(*edges).where(differs)


def violation_counts(e: Estate) -> DataFrame:
    """(rule, violations), one row per rule."""
    rules = {
        "attendance_within_population": beyond_population(e["fct_attendance_daily"]),
        "employee_day_state_is_consistent": contradictory_states(e["int_employee_day"]),
        "supply_identity_holds": broken_supply(
            e["fct_workplace_capacity_daily"], e.settings.pooled_regions
        ),
        "workplace_attributes_agree": disagreeing_floors(e["stg_workplace_space"]),
        "fact_grain_is_unique": repeated_grains(e),
    }
    parts = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(rule).alias("rule"), "violations")
        for rule, df in rules.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def gate_counts(e: Estate) -> DataFrame:
    """The three blocking gates as (gate, violations)."""
    facts, supply = e["fct_attendance_daily"], e["fct_workplace_capacity_daily"]
    checks = {
        "employee_day_grain": duplicate_keys(e["int_employee_day"], GRAINS["int_employee_day"]),
        "attendance_within_population": facts.where(
            "attendance_expected_met > attendance_expected_days OR attendance_daily > employee_days"
        ),
        "supply_identity": supply.where(
            "workstation_waste != available_workstations - attendance_actual OR "
            "delivered_workstations != allocated_workstations + unallocated_workstations"
        ),
    }
    parts = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(gate).alias("gate"), "violations")
        for gate, df in checks.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def hold_gates(e: Estate) -> None:
    """Raise if any blocking gate has violations."""
    shut = gate_counts(e).where("violations > 0").collect()
    if shut:
        raise GateClosed("; ".join(f"{r['gate']}: {r['violations']} rows" for r in shut))

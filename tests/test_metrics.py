"""Metric values, composition rules and refusals."""

from __future__ import annotations

from datetime import date

import pytest
from compare import differences
from pyspark.sql import functions as F

from rollcall import Settings
from rollcall.catalog.oracle import metric_statement
from rollcall.catalog.oracle_queries import ORACLES
from rollcall.catalog.queries import plain
from rollcall.plans import governance, reports
from rollcall.plans.metrics import ATTENDANCE, CAPACITY, METRICS, Metric, MetricLayer, MetricRefused


@pytest.fixture(scope="module")
def layer(estate):
    return MetricLayer(estate)


def test_there_are_fourteen_metrics():
    kinds = [m.kind for m in METRICS.values()]
    assert (kinds.count("atomic"), kinds.count("derived"), kinds.count("composite")) == (4, 8, 2)


CASES = [(m.name, g) for m in METRICS.values() for g in m.grains]


@pytest.mark.parametrize("name,grain", CASES)
def test_metric_equals_sql_at_every_grain(layer, duck, name, grain):
    got = plain(layer.evaluate(name, ["region"], grain))
    assert differences(got, duck, metric_statement(name, ("region",), grain)) is None


def test_keys_may_repeat_the_entity_and_the_day(layer, duck):
    got = plain(layer.evaluate("workstation_waste", ["workplace_code", "local_date"], "day"))
    want = metric_statement("workstation_waste", ("workplace_code", "local_date"), "day")
    assert differences(got, duck, want) is None


def test_filters_add_and_defaults_can_be_lifted(layer, duck):
    got = plain(
        layer.evaluate("attendance_daily", ["city"], None, [F.col("region") == "CN"], include_default_filters=False)
    )
    want = metric_statement("attendance_daily", ("city",), None, "region = 'CN'", weekdays=False)
    assert differences(got, duck, want) is None
    weekdays = layer.evaluate("attendance_daily", ["is_weekend"])
    assert [r["is_weekend"] for r in weekdays.collect()] == [False]


def test_a_composite_ignores_its_own_filter_unless_asked(layer, duck):
    plainly = plain(layer.evaluate("seat_demand_rate", ["city"], "month"))
    filtered = plain(layer.evaluate("seat_demand_rate", ["city"], "month", apply_own_filters=True))
    assert differences(plainly, duck, metric_statement("seat_demand_rate", ("city",), "month")) is None
    want = metric_statement("seat_demand_rate", ("city",), "month", weekdays=True)
    assert differences(filtered, duck, want) is None


def capacity(spark, rows):
    """(day, site, region, allocated, pool, present) with everything else fixed."""
    return spark.createDataFrame(
        rows,
        "local_date date, workplace_code string, region string, allocated_workstations int, "
        "free_sharing_workstations int, attendance_actual int",
    ).selectExpr(
        "*",
        "'2024-W10' AS iso_year_week",
        "'c' AS city",
        "weekday(local_date) > 4 AS is_weekend",
        "10 AS headcount_incumbent",
        "100 AS delivered_workstations",
    )


def d(n):
    return date(2024, 3, n)


def test_regional_supply_is_decided_per_row(spark):
    rows = [(d(4), "W1", "CN", 50, 5, 10), (d(4), "W2", "EMEA", 50, 5, 10)]
    layer = MetricLayer({CAPACITY: capacity(spark, rows)})
    assert layer.evaluate("workstation_waste", ["city"], "day").first()["workstation_waste"] == 85
    pooled = MetricLayer({CAPACITY: capacity(spark, rows)}, Settings(pooled_regions=()))
    assert pooled.evaluate("workstation_waste", ["city"], "day").first()["workstation_waste"] == 90


def test_stocks_average_and_peaks_take_the_maximum_then_sites_add(spark):
    rows = [
        (d(4), "W1", "CN", 50, 5, 10),
        (d(5), "W1", "CN", 50, 5, 30),
        (d(9), "W1", "CN", 50, 5, 99),  # a Saturday
        (d(4), "W2", "CN", 50, 5, 7),
    ]
    layer = MetricLayer({CAPACITY: capacity(spark, rows)})
    week = lambda m, **o: layer.evaluate(m, ["region"], "week", **o).first()[m]
    assert week("headcount_incumbent") == 20
    assert week("attendance_daily") == 20 + 7
    assert week("peak_day_attendance") == 30 + 7
    assert week("peak_day_attendance", include_default_filters=False) == 99 + 7
    assert week("seat_demand_rate") == pytest.approx(37 / 20 * 1.1)
    assert week("seat_demand_absolute") == pytest.approx(37 * 1.1)


def test_a_zero_denominator_gives_null(spark):
    rows = [(d(4), "W1", "CN", 0, 0, 0)]
    layer = MetricLayer({CAPACITY: capacity(spark, rows)})
    assert layer.evaluate("waste_ratio", ["region"], "day").first()["waste_ratio"] is None


def test_last_takes_the_latest_day(spark):
    rows = [(d(5), "W1", "CN", 1, 0, 30), (d(4), "W1", "CN", 1, 0, 10)]
    closing = Metric("closing", "atomic", ("week",), ("region",), "last", CAPACITY, value=lambda s: F.sum("attendance_actual"))
    layer = MetricLayer({CAPACITY: capacity(spark, rows)}, metrics={"closing": closing})
    assert layer.evaluate("closing", ["region"], "week").first()["closing"] == 30


def test_results_can_be_ordered(layer):
    rows = layer.evaluate("headcount_incumbent", ["region"], "week", ordered=True).collect()
    keys = [(r["period"], r["region"]) for r in rows]
    assert keys == sorted(keys)


@pytest.mark.parametrize(
    "name,dims,grain,message",
    [
        ("vibes", [], "day", "unknown metric"),
        ("attendance_rate", ["badge_type"], "day", "cannot be broken down by badge_type"),
        ("seat_demand_rate", [], "day", "not defined at day grain"),
        ("seat_demand_rate", ["dept_l1"], "week", "seat_demand_rate cannot be broken down by dept_l1"),
        ("attendance_rate", [], "quarter", "not defined at quarter grain"),
        ("average_unit_workstation_cost", ["country"], "month", "has no column country"),
    ],
)
def test_refusals(layer, name, dims, grain, message):
    with pytest.raises(MetricRefused, match=message):
        layer.evaluate(name, dims, grain)


def test_a_declared_quarter_is_still_refused(estate):
    odd = Metric("odd", "atomic", ("quarter",), (), "sum", CAPACITY, value=lambda s: F.sum("attendance_actual"))
    with pytest.raises(MetricRefused, match="unsupported time grain"):
        MetricLayer(estate, metrics={"odd": odd}).evaluate("odd", [], "quarter")


def test_headlines(layer, duck):
    assert differences(plain(reports.headlines(layer)), duck, ORACLES["q_metric_headlines"]) is None


def test_recovery_is_close_to_the_first_principles_rate(layer, estate, duck):
    truth = reports.realised_rates(
        estate["stg_hr_employee_snapshot"],
        estate["stg_dept_schedule"],
        estate["int_leave_days"],
        estate["int_travel_days"],
        estate["int_tap_day"],
        estate["stg_workplace"],
    ).select("region", F.col("realised_rate").alias("planted"))
    assert differences(plain(reports.recovery(layer, truth)), duck, ORACLES["q_recovery"]) is None


def test_measures_and_claims_account_for_each_other(spark, estate, duck):
    profiled = governance.profile({m: estate[m] for m in (ATTENDANCE, CAPACITY)})
    claimed, waived = governance.claims(spark), governance.waivers(spark)
    audit = governance.audit_measures(profiled, claimed, waived)
    assert differences(plain(audit), duck, ORACLES["q_measure_audit"]) is None
    assert governance.audit_findings(profiled, claimed, waived).isEmpty()


def test_the_audit_finds_each_kind_of_disagreement(spark):
    fact = spark.createDataFrame([(1, 2, 3, "x")], "known int, stray int, covered int, city string")
    profiled = governance.profile({"fct": fact})
    bad = Metric("m", "atomic", ("day",), (), "sum", "fct", claims=("fct.known", "fct.gone", "nope.x", "plain"))
    waived = governance.waivers(
        spark,
        [
            governance.Waiver(("fct.covered",), "o", "because"),
            governance.Waiver(("fct.old",), "o", "because"),
            governance.Waiver(("fct.a",), "o", "  "),
            governance.Waiver(("fct.b",), "", "because"),
        ],
    )
    got = {
        (r["finding"], r["model"], r["column"])
        for r in governance.audit_findings(profiled, governance.claims(spark, [bad]), waived).collect()
    }
    assert got == {
        ("malformed_claim", "plain", ""),
        ("unknown_model", "nope", "x"),
        ("missing_column", "fct", "gone"),
        ("waiver_without_reason", "fct", "a"),
        ("waiver_without_owner", "fct", "b"),
        ("stale_waiver", "fct", "old"),
        ("stale_waiver", "fct", "a"),
        ("stale_waiver", "fct", "b"),
        ("unclaimed_measure", "fct", "stray"),
    }

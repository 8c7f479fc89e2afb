"""Checks on planted and clean data, grading, the ledger, recall, contracts, table tests."""

from __future__ import annotations

from datetime import date, datetime

import numpy as np
import pandas as pd
import pytest
from compare import differences
from pyspark.sql import functions as F

from rollcall import Estate, Settings
from rollcall.catalog.oracle_queries import ORACLES
from rollcall.catalog.queries import plain
from rollcall.functions.measures import grade
from rollcall.operators.drift import exact_quantiles, psi
from rollcall.operators.verify import (
    ContractBroken,
    TableTests,
    contract_violations,
    orphan_keys,
    require,
    table_test_results,
)
from rollcall.plans import quality, rules, scorecard
from rollcall.plans.declared import TABLE_TESTS
from rollcall.sources.adapter import RetailAdapter
from rollcall.sources.contracts import CONTRACTS

RESULT = ("name", "category", "status", "value", "threshold")


@pytest.fixture(scope="module")
def results(estate):
    return estate.store.put("results", quality.run_checks(estate))


GROUPS = {
    "q_dq_freshness": "freshness",
    "q_dq_integrity": "referential_integrity",
    "q_dq_grain": "grain_uniqueness",
    "q_dq_legality": "status_transition",
    "q_dq_psi": "distribution_drift",
    "q_dq_reconcile": "reconciliation",
    "q_dq_volume": "volume_anomaly",
}


@pytest.mark.parametrize("query", GROUPS)
def test_checks_equal_sql(results, duck, query):
    got = results.where(F.col("category") == GROUPS[query]).select(*RESULT)
    assert differences(plain(got), duck, ORACLES[query]) is None


def test_there_are_23_results_in_7_families_each_explained(results):
    rows = results.collect()
    assert len(rows) == 23 and len({r["name"] for r in rows}) == 23
    assert len({r["category"] for r in rows}) == 7
    for r in rows:
        assert r["explanation"].strip() and not r["explanation"].startswith(r["name"])


def test_scorecard_equals_sql(spark, results, duck):
    as_of = F.lit("2025-09-01").cast("date")
    card = scorecard.scorecard(results, scorecard.ledger(spark), as_of)
    assert differences(plain(card), duck, ORACLES["q_scorecard"]) is None
    assert differences(plain(scorecard.summary(card)), duck, ORACLES["q_scorecard_summary"]) is None
    assert differences(plain(scorecard.by_category(card)), duck, ORACLES["q_scorecard_by_category"]) is None


def test_every_planted_defect_is_found_exactly(spark, sf_dir, results, duck):
    found = scorecard.recall(results, RetailAdapter(spark, sf_dir).planted())
    assert differences(plain(found), duck, ORACLES["q_recall"]) is None
    assert all(r["caught"] and r["exact"] for r in found.collect())


def test_samples_are_bounded_and_totals_are_not(estate, results):
    sample = quality.samples(estate)["snapshot_before_hire_date"]
    total = results.where("name = 'snapshot_before_hire_date'").first()["value"]
    assert sample.count() == 10 < total


def test_grading_is_three_valued_and_inclusive(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.2,), (0.25,), (0.3,)], "v double")
    up = [r[0] for r in df.select(grade(F.col("v"), 0.1, 0.25)).collect()]
    assert up == ["pass", "warn", "warn", "fail", "fail"]
    down = [r[0] for r in df.select(grade(F.col("v"), 0.25, 0.1, higher_is_worse=False)).collect()]
    assert down == ["fail", "fail", "warn", "warn", "pass"]


def reference_psi(base, late, buckets=10):
    buckets = min(buckets, max(min(len(base), len(late)) // 8, 2))
    if len(base) < buckets or len(late) == 0:
        return None
    edges = np.unique(np.quantile(base, np.linspace(0, 1, buckets + 1)))
    if len(edges) < 3:
        return None
    b, a = (np.histogram(x, bins=edges)[0] for x in (base, late))
    b, a = (np.maximum(h / max(h.sum(), 1), 1e-6) for h in (b, a))
    return float(((a - b) * np.log(a / b)).sum())


def values(spark, xs):
    return spark.createDataFrame(pd.DataFrame({"v": np.asarray(xs, dtype=float)}), "v double")


RNG = np.random.default_rng(0)
SAMPLES = {
    "shifted": (RNG.normal(0, 1, 3000), RNG.normal(1.5, 1, 3000)),
    "small": (RNG.normal(size=40), RNG.normal(size=40)),
    "tied": (np.round(RNG.random(300), 2), np.round(RNG.random(170), 2)),
    "constant": (np.zeros(50), np.ones(50)),
    "three values": (np.repeat([0, 0.5, 1.0], 33), np.repeat([0, 0.5, 1.0], [5, 80, 14])),
    "empty baseline": (np.array([]), np.array([1.0])),
    "empty recent": (np.arange(30.0), np.array([])),
}


@pytest.mark.parametrize("case", SAMPLES)
def test_psi_equals_the_histogram_definition(spark, case):
    base, late = SAMPLES[case]
    got = psi(values(spark, base), values(spark, late), "v").first()["psi"]
    want = reference_psi(base, late)
    assert (got is None) == (want is None) and (want is None or got == pytest.approx(want, abs=1e-12))


def test_psi_properties(spark):
    same = values(spark, SAMPLES["shifted"][0])
    assert psi(same, same, "v").first()["psi"] == pytest.approx(0, abs=1e-9)
    rng = np.random.default_rng(0)
    small = [values(spark, rng.normal(size=40)) for _ in range(2)]
    assert psi(*small, "v").first()["psi"] < 0.25
    shifted = [values(spark, x) for x in SAMPLES["shifted"]]
    assert psi(*shifted, "v").first()["psi"] > 0.25


def test_quantiles_are_exact_with_a_heavy_value(spark):
    xs = np.concatenate([np.full(4000, 0.25), RNG.random(2000), [1e6]])
    ps = [0.0, 0.1, 1 / 3, 0.5, 0.7000000000000001, 0.99, 1.0]
    got = exact_quantiles(values(spark, xs), "v", ps).first()["q"]
    assert got == pytest.approx(list(np.quantile(xs, ps)), rel=1e-12)


# -- checks on small hand-made estates -------------------------------------------


def small_estate(spark, **tables):
    return Estate(spark, tables, Settings())


def test_freshness_grades_by_day(spark):
    feeds = {
        "hr_employee_snapshot": "SELECT date'2024-03-10' AS snapshot_date",
        "badge_taps": "SELECT date'2024-03-11' AS ingested_date",
        "leave_requests": "SELECT timestamp_ntz'2024-03-09 23:00:00' AS applied_ts",
        "travel_bookings": "SELECT cast(NULL AS date) AS depart_date",
        "workplace_dim": "SELECT 'S1' AS workplace_code",
    }
    e = small_estate(spark, **{k: spark.sql(q) for k, q in feeds.items()})
    got = {r["name"]: (r["status"], r["value"]) for r in quality.freshness(e).collect()}
    assert got == {
        "freshness_hr_employee_snapshot": ("pass", 0.0),
        "freshness_badge_taps": ("pass", 0.0),  # early, not stale
        "freshness_leave_requests": ("warn", 24.0),  # one day is 24 h, within 26 but over 3/4
        "freshness_travel_bookings": ("fail", None),
        "freshness_workplace_dim": ("pass", 0.0),
    }
    later = F.lit("2024-03-12").cast("date")
    got = {r["name"]: r["status"] for r in quality.freshness(e, later).collect()}
    assert got["freshness_leave_requests"] == "fail" and got["freshness_badge_taps"] == "pass"
    feeds["workplace_dim"] += " WHERE false"
    bare = small_estate(spark, **{k: spark.sql(q) for k, q in feeds.items()})
    got = {r["name"]: (r["status"], r["value"]) for r in quality.freshness(bare).collect()}
    assert got["freshness_workplace_dim"] == ("fail", None)


def test_volume_needs_three_peers_and_uses_the_weekday(spark):
    def days(counts):
        rows = [(d, i) for d, n in counts.items() for i in range(n)]
        return spark.createDataFrame(rows, "d date, i int")

    mondays = {date(2024, 3, 4): 10, date(2024, 3, 11): 12, date(2024, 3, 18): 11, date(2024, 3, 25): 60}
    noise = {date(2024, 3, 23): 900}
    e = small_estate(
        spark,
        stg_badge_taps=days(mondays | noise).withColumnRenamed("d", "business_date"),
        stg_hr_employee_snapshot=days(dict(list(mondays.items())[:2])).withColumnRenamed("d", "snapshot_date"),
    )
    got = {r["name"]: r for r in quality.volume(e).collect()}
    assert got["volume_badge_taps"]["status"] == "fail"
    assert got["volume_badge_taps"]["value"] == pytest.approx(49.0)  # sd 1, floor 1
    assert got["volume_hr_employee_snapshot"]["status"] == "warn"
    assert got["volume_hr_employee_snapshot"]["value"] == 12


def test_drift_is_not_measured_on_short_windows(spark):
    rows = [(date(2024, 3, d), "c", 30, 20) for d in range(1, 6)]
    facts = spark.createDataFrame(
        rows, "local_date date, city string, attendance_expected_days int, attendance_expected_met int"
    )
    row = quality.attendance_rate_drift(small_estate(spark, fct_attendance_daily=facts)).first()
    assert (row["status"], row["value"]) == ("warn", None)
    none = quality.attendance_rate_drift(small_estate(spark, fct_attendance_daily=facts.limit(0))).first()
    assert none["status"] == "warn" and "Too few" in none["explanation"]


def test_orphans_are_counted_in_full(spark):
    facts = spark.range(100).selectExpr("concat('W', id % 25) AS workplace_code", "id")
    dims = spark.createDataFrame([("W0",)], "workplace_code string")
    orphans = orphan_keys(facts, "workplace_code", dims, "workplace_code")
    assert orphans.agg(F.sum("rows")).first()[0] == 96


# -- ledger ------------------------------------------------------------------------


def result_rows(spark, rows):
    return spark.createDataFrame(
        [(n, "c", s, 1.0, 0.0, "x", {}) for n, s in rows],
        "name string, category string, status string, value double, threshold double, "
        "explanation string, details map<string,double>",
    )


def test_ledger_verdicts(spark):
    listed = [scorecard.Expected(n, "o", "r", "2025-01-01") for n in ("known", "fixed", "renamed")]
    card = scorecard.scorecard(
        result_rows(spark, [("known", "fail"), ("fixed", "warn"), ("new", "fail"), ("fine", "pass")]),
        scorecard.ledger(spark, listed),
        F.lit("2025-06-01").cast("date"),
    )
    got = {r["name"]: r["verdict"] for r in card.collect()}
    assert got == {"known": "expected", "fixed": "stale", "new": "unexpected", "fine": "ok", "renamed": "unknown"}
    assert {r["is_overdue"] for r in card.where("owner IS NOT NULL").collect()} == {True}
    total = scorecard.summary(card).first()
    assert (total["n_pass"], total["n_warn"], total["n_fail"]) == (1, 1, 2)
    assert (total["worst"], total["passed"]) == ("fail", False)


def test_a_known_failure_alone_passes(spark):
    listed = [scorecard.Expected("known", "o", "r", "2025-01-01")]
    card = scorecard.scorecard(
        result_rows(spark, [("known", "fail"), ("fine", "pass")]), scorecard.ledger(spark, listed)
    )
    assert scorecard.summary(card).first()["passed"] is True


def test_every_ledger_entry_has_owner_reason_and_review_date():
    for x in scorecard.LEDGER:
        assert x.owner and x.reason and date.fromisoformat(x.review_by)


# -- contracts and table tests -------------------------------------------------------


def test_the_feeds_keep_their_contracts(estate):
    for name, contract in CONTRACTS.items():
        require(contract_violations(estate[name], contract))


def test_a_contract_reports_every_violation_at_once(spark):
    rows = [
        ("L1", "E1", "annual", "2024-03-01", "2024-03-02", "approved", datetime(2024, 1, 1), 1),
        ("L1", None, "nap", "not a date", "2024-03-02", "approved", datetime(2024, 1, 1), 1),
    ]
    feed = spark.createDataFrame(
        rows,
        "leave_id string, emp_id string, leave_type string, start_date string, end_date string, "
        "state string, applied_ts timestamp_ntz, extra int",
    )
    found = contract_violations(feed, CONTRACTS["leave_requests"])
    broken = {(r["column"], r["rule"]): r["violations"] for r in found.where("violations > 0").collect()}
    assert broken == {
        ("emp_id", "not_null"): 1,
        ("leave_type", "domain"): 1,
        ("start_date", "type"): 1,
        ("status", "missing"): 1,
        ("state", "unexpected"): 1,
        ("extra", "unexpected"): 1,
        ("leave_id", "unique"): 1,
    }
    with pytest.raises(ContractBroken, match="emp_id not_null: 1"):
        require(found)


def test_contract_check_equals_sql(estate, duck):
    out = None
    for name, contract in CONTRACTS.items():
        part = contract_violations(estate[name], contract)
        out = part if out is None else out.unionByName(part)
    assert differences(plain(out), duck, ORACLES["q_contract_violations"]) is None


def test_declared_tests_equal_sql(estate, duck):
    got = table_test_results(estate, TABLE_TESTS)
    assert differences(plain(got), duck, ORACLES["q_generic_tests"]) is None
    assert got.count() == 63


def test_declared_tests_find_violations(spark):
    a = spark.createDataFrame([(1, "x"), (1, None), (None, "z")], "id int, v string")
    b = spark.createDataFrame([(2,)], "id int")
    tests = {"a": TableTests(("id", "v"), ("id",), (("v", ("x",)),), (("id", "b", "id"),))}
    got = {(r["column"], r["test"]): r["violations"] for r in table_test_results({"a": a, "b": b}, tests).collect()}
    assert got == {
        ("id", "not_null"): 1,
        ("v", "not_null"): 1,
        ("id", "unique"): 1,
        ("v", "accepted_values"): 1,
        ("id", "relationships"): 2,
    }


def test_a_shut_gate_raises(spark, estate):
    doubled = estate["int_employee_day"].unionAll(estate["int_employee_day"])
    e = Estate(
        spark,
        {
            "int_employee_day": doubled,
            "fct_attendance_daily": estate["fct_attendance_daily"],
            "fct_workplace_capacity_daily": estate["fct_workplace_capacity_daily"],
        },
    )
    with pytest.raises(rules.GateClosed, match="employee_day_grain"):
        rules.hold_gates(e)

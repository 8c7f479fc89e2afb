"""Operators on hand-written rows and against brute force on random ones."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rollcall.functions import times
from rollcall.operators.anchors import anchor_day
from rollcall.operators.history import versions
from rollcall.operators.intervals import expand_days, first_per_key
from rollcall.operators.repeats import drop_repeats

NINE = datetime(2024, 3, 4, 9, 0, 0)


def swipes(spark, rows):
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, n int")


def after(seconds, start=NINE):
    return start + timedelta(seconds=seconds)


def test_a_chain_of_repeats_collapses_to_its_first(spark):
    rows = [("a", after(s), i) for i, s in enumerate((0, 80, 160, 251))]
    kept = drop_repeats(swipes(spark, rows), ["k"], "ts", 90)
    assert sorted(r["n"] for r in kept.collect()) == [0, 3]


def test_seconds_are_boundaries_crossed_not_elapsed_time(spark):
    # 90.2 s elapsed but 91 boundaries: not a repeat. 90.8 s elapsed, 90 boundaries: a repeat.
    a = [("a", NINE.replace(microsecond=900_000), 0), ("a", after(91).replace(microsecond=100_000), 1)]
    b = [("b", NINE.replace(microsecond=100_000), 2), ("b", after(90).replace(microsecond=900_000), 3)]
    kept = drop_repeats(swipes(spark, a + b), ["k"], "ts", 90)
    assert sorted(r["n"] for r in kept.collect()) == [0, 1, 2]


@pytest.mark.parametrize("slice_seconds", [60, 100, 3600, 86400])
def test_time_slices_do_not_change_the_result(spark, slice_seconds):
    """One key holds most rows; many gaps straddle slice ends and some span several slices."""
    rng = random.Random(7)
    rows, t = [], NINE
    for i in range(1500):
        t += timedelta(seconds=rng.choice([0, 1, 30, 89, 90, 91, 92, 200, 4000]), milliseconds=rng.randrange(999))
        rows.append(("hot" if rng.random() < 0.8 else f"k{i % 3}", t, i))
    want, last = set(), {}
    for k, ts, n in rows:
        prior = last.get(k)
        whole = lambda x: int((x - datetime(1970, 1, 1)).total_seconds() // 1)
        if prior is None or whole(ts) - whole(prior) > 90:
            want.add(n)
        last[k] = ts
    kept = drop_repeats(swipes(spark, rows), ["k"], "ts", 90, ("n",), slice_seconds)
    assert {r["n"] for r in kept.collect()} == want


def test_second_counts_ignore_the_session_zone(spark):
    rows = [(datetime(2024, 3, 10, 1, 30), datetime(2024, 3, 10, 2, 30))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    gap = df.select(times.seconds_crossed(F.col("a"), F.col("b")).alias("s"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert gap.first()["s"] == 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_local_time_follows_daylight_saving_per_row(spark):
    rows = [
        (datetime(2024, 7, 1, 12), "America/New_York"),
        (datetime(2024, 1, 1, 12), "America/New_York"),
        (datetime(2024, 1, 1, 23, 30), "Asia/Shanghai"),
    ]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, tz string")
    got = [r[0] for r in df.select(times.local_time(F.col("ts"), F.col("tz"))).collect()]
    assert got == [datetime(2024, 7, 1, 8), datetime(2024, 1, 1, 7), datetime(2024, 1, 2, 7, 30)]


def test_iso_week_uses_the_iso_year(spark):
    df = spark.createDataFrame([(date(2024, 12, 30),), (date(2023, 1, 1),), (date(2025, 6, 3),)], "d date")
    got = [r[0] for r in df.select(times.iso_week(F.col("d"))).collect()]
    assert got == ["2025-W01", "2022-W52", "2025-W23"]


def anchored(spark, rows, **options):
    """rows of (who, in/out, local time); gives the assigned day per row number."""
    df = spark.createDataFrame(
        [(w, d, t, i) for i, (w, d, t) in enumerate(rows)], "k string, d string, ts timestamp_ntz, n int"
    )
    out = anchor_day(
        df, "k", "ts", F.col("d") == "in", times.cutover_date(F.col("ts"), 4), "day", **options
    )
    return {r["n"]: r["day"] for r in out.collect()}


def at(day, hour, minute=0):
    return datetime(2024, 3, day, hour, minute)


def test_an_exit_belongs_to_the_day_of_its_entry(spark):
    got = anchored(
        spark,
        [
            ("night", "in", at(4, 17, 30)),
            ("night", "out", at(5, 5, 30)),
            ("early", "in", at(5, 3)),
            ("alone", "out", at(5, 2)),
            ("alone2", "out", at(5, 5)),
            ("missed", "in", at(4, 9)),
            ("missed", "out", at(4, 18)),
            ("missed", "out", at(5, 18)),
            ("tie", "out", at(6, 12)),
            ("tie", "in", at(6, 12)),
        ],
    )
    d = lambda n: date(2024, 3, n)
    assert got == {0: d(4), 1: d(4), 2: d(4), 3: d(4), 4: d(5), 5: d(4), 6: d(4), 7: d(4), 8: d(6), 9: d(6)}


def test_the_look_back_can_be_limited(spark):
    rows = [("m", "in", at(4, 9)), ("m", "out", at(5, 18)), ("m", "out", at(9, 18))]
    assert anchored(spark, rows)[2] == date(2024, 3, 4)
    limited = anchored(spark, rows, max_age_days=2)
    assert limited[1] == date(2024, 3, 4) and limited[2] == date(2024, 3, 9)


def test_anchoring_equals_a_running_look_back(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(900):
        who = "hot" if rng.random() < 0.5 else f"e{rng.randrange(6)}"
        moment = at(1, 0) + timedelta(minutes=rng.randrange(60 * 24 * 25), seconds=rng.randrange(60))
        rows.append((who, rng.choice(["in", "out", "out"]), moment))
    want, order = {}, sorted(range(len(rows)), key=lambda i: (rows[i][2], rows[i][1]))
    seen = {}
    for i in order:
        who, kind, ts = rows[i]
        clock = (ts - timedelta(hours=4)).date()
        if kind == "in":
            seen[who] = clock
        want[i] = seen.get(who, clock)
    assert anchored(spark, rows) == want


def test_reversed_and_open_intervals_give_no_days(spark):
    d = lambda n: date(2024, 3, n)
    rows = [("a", d(4), d(6)), ("b", d(6), d(4)), ("c", d(4), None), ("d", d(7), d(7))]
    df = spark.createDataFrame(rows, "k string, s date, e date")
    got = sorted((r["k"], r["day"]) for r in expand_days(df, "s", "e", "day").collect())
    assert got == [("a", d(4)), ("a", d(5)), ("a", d(6)), ("d", d(7))]


def test_first_per_key_sorts_nulls_last(spark):
    rows = [("a", None, "x"), ("a", 2, "y"), ("a", 2, "w"), ("b", None, "z")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    got = first_per_key(df, ["k"], [F.col("o"), F.col("v")], ["v"])
    assert {r["k"]: r["v"] for r in got.collect()} == {"a": "w", "b": "z"}


def test_versions_are_found_by_a_single_sort(spark):
    """Each version is read off its last row: one exchange, one sort, no grouping. Repeats and undated rows count."""
    rows = [("a", 1, "x", 1), ("a", 1, "x", 2), ("a", 2, "x", 0), ("a", 4, "y", 5), ("a", 4, "y", 5), ("a", 5, "x", 9)]
    rows += [("b", None, "p", 1), ("b", 3, "p", 2), ("c", None, "q", 1), (None, 7, "n", 1), (None, 8, None, 1)]
    df = spark.createDataFrame(rows, "k string, day int, v string, c int")
    out = versions(df, "k", "day", F.col("v"), ["v", "c"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1 and "Aggregate" not in plan
    got = sorted((tuple(r) for r in out.collect()), key=str)
    want = [
        ("a", 1, 1, 2, 3, False, "x", 0),
        ("a", 2, 4, 4, 2, False, "y", 5),
        ("a", 3, 5, 5, 1, True, "x", 9),
        ("b", 1, 3, 3, 2, True, "p", 2),
        ("c", 1, None, None, 1, None, "q", 1),
        (None, 1, 7, 7, 1, False, "n", 1),
        (None, 2, 8, 8, 1, True, None, 1),
    ]
    assert got == sorted(want, key=str)


def test_versions_open_on_change_and_survive_gaps(spark):
    d = lambda n: date(2024, 3, n)
    rows = [
        ("e", d(1), "A", 1),
        ("e", d(2), "A", 2),
        ("e", d(3), "B", 3),
        ("e", d(4), "A", 4),
        ("e", d(9), "A", 5),
        ("f", d(1), None, 6),
        ("f", d(2), None, 7),
    ]
    df = spark.createDataFrame(rows, "k string, day date, v string, c int")
    got = versions(df, "k", "day", F.col("v"), ["v", "c"]).orderBy("k", "version_number").collect()
    facts = [
        (r["k"], r["version_number"], r["valid_from"], r["valid_to"], r["snapshot_days"], r["is_current"], r["c"])
        for r in got
    ]
    assert facts == [
        ("e", 1, d(1), d(2), 2, False, 2),
        ("e", 2, d(3), d(3), 1, False, 3),
        ("e", 3, d(4), d(9), 2, True, 5),
        ("f", 1, d(1), d(2), 2, True, 7),
    ]


def test_a_policy_expands_to_a_row_per_weekday(spark):
    from rollcall.plans.presence import weekday_policy

    df = spark.sql("SELECT 'a-1' AS dept_l2, 'a' AS dept_l1, array(0, 2) AS office_days, 'v1' AS policy_version")
    rows = weekday_policy(df).orderBy("weekday").collect()
    assert [r["is_scheduled_office_day"] for r in rows] == [True, False, True] + [False] * 4
    assert {r["required_days_per_week"] for r in rows} == {2}

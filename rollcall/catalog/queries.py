"""Named queries over the retail test tables, one per operator group."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators.ordering import numbered
from rollcall.operators.verify import TableTests, contract_violations, table_test_results
from rollcall.plans import governance, presence, quality, reports, rules, scorecard, staging
from rollcall.plans.declared import TABLE_TESTS
from rollcall.plans.estate import SHARED, Estate
from rollcall.plans.increments import affected_days, build_daily, refresh
from rollcall.plans.metrics import ATTENDANCE, CAPACITY, METRICS, MetricLayer
from rollcall.settings import Settings
from rollcall.sources.adapter import RetailAdapter, table
from rollcall.sources.contracts import CONTRACTS, Contract, Field
from rollcall.sources.days import DayRange, DayTables, LandedFeeds
from rollcall.sources.feeds import (
    landed_violations,
    load_report,
    read_feeds,
    read_manifest,
    write_feed,
    write_manifest,
)
from rollcall.sources.store import SessionStore, TableStore

Query = Callable[[SparkSession, str], DataFrame]


def estate(spark: SparkSession, sf_dir: str) -> Estate:
    """The model graph over the retail tables; what it stores, the queries of a session share."""
    return Estate(spark, RetailAdapter(spark, sf_dir), store=SessionStore.of(spark))


def plain(df: DataFrame) -> DataFrame:
    """Engine-neutral values: text for dates and times, 64-bit integers, six decimals."""

    def show(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FractionalType, T.DecimalType)):
            c = F.round(c.cast("double"), 6)
        return c.alias(f.name)

    return df.select(*(show(f) for f in df.schema))


def _model(name: str, *settled: str) -> Query:
    return lambda spark, sf: estate(spark, sf).settle(*settled)[name]


def taps_localised(spark, sf):
    e = estate(spark, sf)
    raw = staging.known_site_taps(e["badge_taps"], e["stg_workplace"])
    local = staging.localise(raw, e["stg_workplace"])
    return local.select(
        "emp_id",
        "workplace_code",
        "direction",
        "device_id",
        "tap_ts_utc",
        "timezone",
        "tap_ts_local",
    )


def taps_deduped(spark, sf):
    e = estate(spark, sf)
    return staging.kept_taps(
        e["badge_taps"], e["stg_workplace"], e.settings.repeat_window_seconds
    )


def unknown_site_taps(spark, sf):
    e = estate(spark, sf)
    return staging.unknown_site_taps(e["badge_taps"], e["stg_workplace"])


def population_spine(spark, sf):
    a = RetailAdapter(spark, sf)
    people = a.people().select("c_custkey", "hire_date", "term_date")
    days = presence.visible_days(people, a.start, a.end)
    return days.groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("visible_days"),
        F.min("snapshot_date").alias("first_day"),
        F.max("snapshot_date").alias("last_day"),
    )


def state_counts(spark, sf):
    return reports.state_counts(estate(spark, sf)["int_employee_day"])


def state_composition(spark, sf):
    return reports.state_composition(estate(spark, sf)["int_employee_day"])


# -- metrics ------------------------------------------------------------------


def metric(name: str, dims=("region",), grain: str | None = None, **options) -> Query:
    """A metric over a fact read once stays one plan; a composite's fact is stored first."""

    def run(spark, sf):
        e = estate(spark, sf)
        if METRICS[name].is_composite:
            e.settle(CAPACITY)
        return MetricLayer(e).evaluate(name, dims, grain, **options)

    return run


def metric_caller_filter(spark, sf):
    two_regions = [F.col("region").isin("CN", "AMER")]
    return metric("headcount_incumbent", ("city",), "month", filters=two_regions)(spark, sf)


def metric_headlines(spark, sf):
    e = estate(spark, sf).settle("int_employee_day", ATTENDANCE, CAPACITY)
    return reports.headlines(MetricLayer(e))


# -- rules, contracts, tests --------------------------------------------------


def rule_violations(spark, sf):
    e = estate(spark, sf).settle_read("int_employee_day", ATTENDANCE, CAPACITY)
    return e.put("violations", rules.violation_counts(e))


def gates(spark, sf):
    e = estate(spark, sf).settle_read("int_employee_day", ATTENDANCE, CAPACITY)
    return e.put("gates", rules.gate_counts(e))


def contract_feeds(spark, sf):
    feeds = RetailAdapter(spark, sf)
    out = None
    for name, feed in feeds.items():
        part = contract_violations(feed, CONTRACTS[name])
        out = part if out is None else out.unionByName(part)
    return out


def _faulty(e: Estate) -> Estate:
    """Built tables with faults planted by the day of the month and the floor."""
    e.settle_read("int_employee_day", ATTENDANCE, CAPACITY)
    day = F.dayofmonth("local_date")

    def repeated(df: DataFrame, times) -> DataFrame:
        return df.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), times))).drop("_copy")

    def moved(df: DataFrame, column: str, when, value) -> DataFrame:
        return df.withColumn(column, F.when(when, value).otherwise(F.col(column)))

    days = moved(e["int_employee_day"], "employee_day_state", day == 4, F.lit(None))
    days = moved(days, "employee_day_state", day == 5, F.lit("on_assignment"))
    days = moved(days, "state_rule_id", day == 5, F.lit(5))
    days = repeated(days, F.when(day == 11, 3).when(day == 12, 2).otherwise(1))
    seen = moved(e[ATTENDANCE], "attendance_daily", day == 3, F.col("employee_days") + 1)
    owed = F.col("attendance_expected_days") + 2
    seen = repeated(moved(seen, "attendance_expected_met", day == 7, owed), F.when(day == 9, 2).otherwise(1))
    desks = moved(e[CAPACITY], "unallocated_workstations", day == 6, F.col("unallocated_workstations") + 1)
    desks = moved(desks, "available_workstations", day == 8, F.col("available_workstations") + 5)
    desks = moved(desks, "workstation_waste", day == 8, F.col("workstation_waste") + 5)
    space = moved(e["stg_workplace_space"], "city", F.col("floor") == 1, F.lit("ELSEWHERE"))
    tables = {
        "int_employee_day": days,
        ATTENDANCE: seen,
        CAPACITY: desks,
        "stg_workplace_space": space,
        "fct_floor_presence_hourly": e["fct_floor_presence_hourly"],
    }
    return Estate(e.spark, tables, e.settings)


def rules_planted(spark, sf):
    e = estate(spark, sf)
    return e.put("violations", rules.violation_counts(_faulty(e)))


def gates_planted(spark, sf):
    e = estate(spark, sf)
    return e.put("gates", rules.gate_counts(_faulty(e)))


def grain_planted(spark, sf):
    e = estate(spark, sf)
    return e.put("results", quality.run_checks(_faulty(e), ("grain",))).select(*RESULT)


def freshness_planted(spark, sf):
    """Taps and travel that end in the range of a warning, leave that ends too early, sites that never came."""
    e = estate(spark, sf)
    last = e["hr_employee_snapshot"].agg(F.max("snapshot_date")).scalar()
    feeds = {
        "hr_employee_snapshot": e["hr_employee_snapshot"],
        "badge_taps": e["badge_taps"].where(F.col("ingested_date") <= F.date_sub(last, 2)),
        "travel_bookings": e["travel_bookings"].where(F.col("depart_date") <= F.date_sub(last, 1)),
        "leave_requests": e["leave_requests"].where(F.col("applied_ts").cast("date") <= F.date_sub(last, 5)),
        "workplace_dim": e["workplace_dim"].where("false"),
    }
    return quality.run_checks(Estate(spark, feeds, e.settings), ("freshness",)).select(*RESULT)


def integrity_planted(spark, sf):
    """Facts with sites and days that no dimension knows, and with none at all."""
    e = estate(spark, sf).settle("int_employee_day", ATTENDANCE, CAPACITY)
    day, site = F.dayofmonth("local_date"), F.col("workplace_code")

    def lost(name: str, on: int) -> DataFrame:
        return e[name].withColumn("workplace_code", F.when(day == on, "NOWHERE").when(day != on + 8, site))

    late = F.when(F.dayofmonth("local_date") == 14, F.date_add("local_date", 36525)).otherwise(F.col("local_date"))
    tables = {
        ATTENDANCE: lost(ATTENDANCE, 2).withColumn("local_date", late),
        CAPACITY: lost(CAPACITY, 3),
        "fct_floor_presence_hourly": lost("fct_floor_presence_hourly", 4),
        "dim_workplace": e["dim_workplace"],
        "dim_date": e["dim_date"],
    }
    return e.put("results", quality.run_checks(Estate(spark, tables, e.settings), ("integrity",))).select(*RESULT)


# A contract the orders table does not keep, to see every kind of rule count something.
STRICT_ORDERS = Contract(
    "orders",
    (
        Field("o_orderkey", "int", above=99),
        Field("o_custkey", "int", at_least=10, at_most=100),
        Field("o_orderstatus", domain=("F", "O")),
        Field("o_totalprice", "double", above=1000),
        Field("o_orderpriority", "double"),
        Field("o_clerk"),
    ),
    grain=("o_custkey", "o_orderstatus"),
)


def contract_orders(spark, sf):
    return contract_violations(table(spark, sf, "orders"), STRICT_ORDERS)


def generic_tests(spark, sf):
    e = estate(spark, sf).settle_read(*SHARED)
    return e.put("tests", table_test_results(e, TABLE_TESTS))


RETAIL_TESTS = {
    "orders": TableTests(
        not_null=("o_orderkey", "o_custkey"),
        unique=("o_orderkey", "o_custkey"),
        accepted=(("o_orderstatus", ("F", "O")),),
        refers=(("o_custkey", "customer", "c_custkey"),),
    ),
    "customer": TableTests(
        accepted=(("c_mktsegment", ("BUILDING", "MACHINERY")),),
        refers=(("c_custkey", "events", "user_id"), ("c_nationkey", "nation", "n_nationkey")),
    ),
}


def generic_tests_retail(spark, sf):
    tables = {n: table(spark, sf, n) for n in ("orders", "customer", "events", "nation")}
    return table_test_results(tables, RETAIL_TESTS)


# -- quality ------------------------------------------------------------------

RESULT = ("name", "category", "status", "value", "threshold")


def _checks(names: tuple[str, ...], *settled: str) -> Query:
    def run(spark, sf):
        e = estate(spark, sf).settle(*settled)
        return e.put("results", quality.run_checks(e, names)).select(*RESULT)

    return run


def _results(spark, sf) -> tuple[Estate, DataFrame]:
    e = estate(spark, sf).settle_read(*SHARED)
    return e, e.put("results", quality.run_checks(e))


def score(spark, sf):
    e, results = _results(spark, sf)
    as_of = F.lit("2025-09-01").cast("date")
    return scorecard.scorecard(results, scorecard.ledger(spark), as_of)


def score_summary(spark, sf):
    e, results = _results(spark, sf)
    card = scorecard.scorecard(results, scorecard.ledger(spark))
    return scorecard.summary(card)


def score_by_category(spark, sf):
    e, results = _results(spark, sf)
    card = scorecard.scorecard(results, scorecard.ledger(spark))
    return scorecard.by_category(card)


def recall(spark, sf):
    a = RetailAdapter(spark, sf)
    e = estate(spark, sf).settle("stg_badge_taps", "int_employee_scd2")
    graded = {d[2] for d in scorecard.DEFECTS}
    results = e.put("results", quality.run_checks(e, [n for n in quality.CHECKS if n in graded]))
    manifest = f"{TableStore(spark).root}/manifest.json"
    write_manifest(a.planted(), manifest)
    return scorecard.recall(results, read_manifest(spark, manifest))


def quality_samples(spark, sf):
    """The top offenders of the termination checks, as one frame."""
    e = estate(spark, sf).settle("stg_badge_taps", "int_employee_scd2")
    s = quality.samples(e)
    active = s["active_after_termination"].select(
        F.lit("active_after_termination").alias("check"), "emp_id", F.col("bad_rows").alias("rows")
    )
    taps = s["tap_after_termination"].select(
        F.lit("tap_after_termination").alias("check"), "emp_id", F.col("taps").alias("rows")
    )
    return e.put("samples", active.unionByName(taps))


def samples_planted(spark, sf):
    """The worst offenders of all twelve checks that name rows, over facts with lost sites, late days and repeats."""
    e = estate(spark, sf).settle("stg_badge_taps", "int_employee_scd2", "int_employee_day", ATTENDANCE, CAPACITY)
    day, site = F.dayofmonth("local_date"), F.col("workplace_code")

    def repeated(df: DataFrame, on: int) -> DataFrame:
        return df.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.when(day == on, 2).otherwise(1)))).drop("_copy")

    def lost(name: str, on: int) -> DataFrame:
        place = F.when(day == on, "NOWHERE").when(day != on + 8, site)
        return repeated(e[name], 9).withColumn("workplace_code", place)

    late = F.when(day == 14, F.date_add("local_date", 36525)).otherwise(F.col("local_date"))
    tables = {
        "int_employee_day": repeated(e["int_employee_day"], 11),
        ATTENDANCE: lost(ATTENDANCE, 2).withColumn("local_date", late),
        CAPACITY: lost(CAPACITY, 3),
        "fct_floor_presence_hourly": lost("fct_floor_presence_hourly", 4),
    }
    whole = ("dim_workplace", "dim_date", "stg_hr_employee_snapshot", "stg_badge_taps", "int_employee_scd2", "dim_employee")
    return e.put("offenders", quality.worst_offenders(Estate(spark, tables | {n: e[n] for n in whole}, e.settings)))


def check_details(spark, sf):
    """The numbers behind the checks, one row each."""
    e = estate(spark, sf).settle_read(*SHARED)
    names = (
        "active_after_termination",
        "tap_after_termination",
        "missing_workplace_timezone",
        "attendance_rate_drift",
        "reconciliation",
        "volume",
    )
    results = e.put("results", quality.run_checks(e, names))
    return results.select("name", F.explode("details").alias("measure", "amount"))


def drift_planted(spark, sf):
    """Drift that can't be measured: of each city the days before the middle have one and the same rate."""
    e = estate(spark, sf)
    first = e["hr_employee_snapshot"].agg(F.min("snapshot_date")).scalar()
    early = F.col("local_date") < F.date_add(first, 20)
    met = F.when(early, F.col("attendance_expected_days")).otherwise(F.col("attendance_expected_met"))
    facts = {ATTENDANCE: e[ATTENDANCE].withColumn("attendance_expected_met", met)}
    found = quality.run_checks(Estate(spark, facts, e.settings), ("attendance_rate_drift",))
    return found.select(*RESULT, F.col("details")["city_days_left_out"].alias("left_out"))


# -- reports ------------------------------------------------------------------


def supply_ladder(spark, sf):
    return reports.supply_ladder(estate(spark, sf)[CAPACITY])


def _realised(e: Estate) -> DataFrame:
    return reports.realised_rates(
        e["stg_hr_employee_snapshot"],
        e["stg_dept_schedule"],
        e["int_leave_days"],
        e["int_travel_days"],
        e["int_tap_day"],
        e["stg_workplace"],
    )


def realised_rates(spark, sf):
    return _realised(estate(spark, sf))


def recovery(spark, sf):
    e = estate(spark, sf).settle("stg_badge_taps")
    truth = _realised(e).select("region", F.col("realised_rate").alias("planted"))
    return reports.recovery(MetricLayer(e), truth)


def layer_counts(spark, sf):
    e = estate(spark, sf).settle(*SHARED)
    return e.put("counts", e.layer_counts())


def measure_audit(spark, sf):
    e = estate(spark, sf).settle("int_employee_day")
    profiled = governance.profile({m: e[m] for m in (ATTENDANCE, CAPACITY)})
    return governance.audit_measures(profiled, governance.claims(spark), governance.waivers(spark))


def findings_planted(spark, sf):
    """Claims and waivers that disagree with the facts in every way, next to what the facts hold of the columns."""
    e = estate(spark, sf).settle("int_employee_day")
    profiled = e.store.put("profile", governance.profile({m: e[m] for m in (ATTENDANCE, CAPACITY)}))
    wrong = [(ATTENDANCE, "", "a"), ("fct_badges", "taps", "b"), (ATTENDANCE, "overtime_days", "c")]
    claims = governance.claims(spark).where("column <> 'floating_headcount'")
    claims = claims.unionByName(spark.createDataFrame(wrong, claims.schema))
    waivers = governance.waivers(spark)
    odd = [(ATTENDANCE, "leave_days", " ", "counted"), (ATTENDANCE, "travel_days", "desk", None), (CAPACITY, "seats", "desk", "old")]
    waivers = waivers.unionByName(spark.createDataFrame(odd, waivers.schema))
    found = governance.audit_findings(profiled, claims, waivers)
    return found.join(profiled.select("model", "column", "rows", "non_null"), ["model", "column"], "left")


def metric_ordered(spark, sf):
    """A metric in the order of its keys, and the place of each row in it."""
    e = estate(spark, sf)
    daily = MetricLayer(e).evaluate("attendance_daily", ("city", "region"), "day", ordered=True)
    return numbered(daily, e.store, "ordered")


def table_tests_planted(spark, sf):
    """Declared tests over orders of which some have lost their key or customer."""
    k = F.col("o_orderkey")
    orders = table(spark, sf, "orders").select(
        F.when(k % 11 != 4, k).alias("o_orderkey"), F.when(k % 7 != 3, F.col("o_custkey")).alias("o_custkey")
    )
    tables = {"orders": orders, "customer": table(spark, sf, "customer")}
    declared = TableTests(
        not_null=("o_orderkey", "o_custkey"), unique=("o_orderkey",), refers=(("o_custkey", "customer", "c_custkey"),)
    )
    return table_test_results(tables, {"orders": declared})


# -- sources ------------------------------------------------------------------


def _landed(spark, sf) -> str:
    store = TableStore(spark)
    feeds = RetailAdapter(spark, sf)
    for name, feed in feeds.items():
        write_feed(feed, store.root, name)
    return store.root


def partitioned_roundtrip(spark, sf):
    """Write all feeds as landed files, read them back, and total each."""
    feeds = read_feeds(spark, _landed(spark, sf))
    parts = [
        feeds["hr_employee_snapshot"].agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("snapshot_date").alias("days")
        ),
        feeds["badge_taps"].agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct(F.col("tap_ts_utc").cast("date")).alias("days"),
        ),
        *(
            feeds[n].agg(F.count(F.lit(1)).alias("rows"), F.lit(0).cast("bigint").alias("days"))
            for n in CONTRACTS
            if CONTRACTS[n].day is None
        ),
    ]
    names = [n for n in CONTRACTS if CONTRACTS[n].day] + [
        n for n in CONTRACTS if CONTRACTS[n].day is None
    ]
    out = None
    for name, part in zip(names, parts):
        tagged = part.select(F.lit(name).alias("feed"), "rows", "days")
        out = tagged if out is None else out.unionByName(tagged)
    return out


def landed_days(spark, sf):
    """Load report of all feeds: rows and partitions from the files themselves."""
    return load_report(spark, _landed(spark, sf)).drop("violations")


def landed_days_planted(spark, sf):
    """Load report of landed files of which some days and one undated feed break their contract."""
    feeds, root = RetailAdapter(spark, sf), TableStore(spark).root
    first, days = F.lit(feeds.first_day), F.col("snapshot_date")
    hr = feeds["hr_employee_snapshot"]
    hr = hr.withColumn("employment_status", F.when(days != F.date_add(first, 3), F.col("employment_status")))
    hr = hr.withColumn("employee_type", F.when(days == F.date_add(first, 5), "robot").otherwise(F.col("employee_type")))
    twice = F.explode(F.array_repeat(F.lit(1), F.when(days == F.date_add(first, 7), 2).otherwise(1)))
    write_feed(hr.withColumn("copy", twice).drop("copy"), root, "hr_employee_snapshot")
    taps, tapped = feeds["badge_taps"], F.col("tap_ts_utc").cast("date")
    sideways = F.when(tapped == F.date_add(first, 9), "sideways").otherwise(F.col("direction"))
    write_feed(taps.withColumn("direction", sideways), root, "badge_taps")
    write_feed(feeds["travel_bookings"], root, "travel_bookings")
    feeds["workplace_dim"].drop("timezone").withColumn("note", F.lit("x")).write.parquet(f"{root}/workplace_dim")
    return load_report(spark, root, ("hr_employee_snapshot", "badge_taps", "travel_bookings", "workplace_dim"))


def contract_landed(spark, sf):
    """Contracts over landed files with planted faults: two feeds with columns lost, added and retyped."""
    feeds, root = RetailAdapter(spark, sf), TableStore(spark).root
    k = F.substring("leave_id", 2, 20).cast("bigint")
    times = F.when(k % 106 == 2, 3).when(k % 53 == 2, 2).otherwise(1)
    leave = feeds["leave_requests"].select(
        "leave_id",
        F.when(k % 89 != 3, F.col("emp_id")).alias("emp_id"),
        F.when(k % 41 == 1, "holiday").otherwise(F.col("leave_type")).alias("leave_type"),
        F.when(k % 97 == 5, "soon").otherwise(F.col("start_date").cast("string")).alias("start_date"),
        "end_date",
        "applied_ts",
        F.lit("x").alias("note"),
        F.explode(F.array_repeat(F.lit(1), times)).alias("copy"),
    )
    leave.drop("copy").write.parquet(f"{root}/leave_requests")
    space = feeds["workplace_dim"].drop("timezone")
    space = space.withColumn("floor", F.when(F.col("floor") == 1, 0).otherwise(F.col("floor")))
    space.write.parquet(f"{root}/workplace_dim")
    return landed_violations(spark, root, ("leave_requests", "workplace_dim"))


# -- day ranges ---------------------------------------------------------------

# An age limit makes a range need a bounded stretch of taps around it.
TWO_DAYS = Settings(max_anchor_age_days=2)


def _middle(spark, sf, first: int, last: int) -> DayRange:
    start = RetailAdapter(spark, sf).first_day
    return DayRange(start + timedelta(days=first), start + timedelta(days=last))


def ranged_metric(name: str, dims, grain: str | None) -> Query:
    """A metric of one week, from the partitions of that week and what it looks back and ahead for."""

    def run(spark, sf):
        feeds = LandedFeeds(spark, _landed(spark, sf))
        e = Estate(spark, feeds, TWO_DAYS, TableStore(spark), _middle(spark, sf, 9, 15))
        return MetricLayer(e).evaluate(name, dims, grain)

    return run


def _late(spark, sf) -> tuple[RetailAdapter, dict]:
    """Taps reported a day late on two days, and requests for leave that begins on one of these."""
    feeds, days = RetailAdapter(spark, sf), _middle(spark, sf, 13, 14)
    tapped = F.col("tap_ts_utc").cast("date")
    return feeds, {
        "badge_taps": tapped.between(days.first, days.last) & (F.col("ingested_date") > tapped),
        "leave_requests": F.col("start_date") == F.lit(days.last),
    }


def days_affected(spark, sf):
    feeds, late = _late(spark, sf)
    return affected_days({n: feeds[n].where(late[n]) for n in late}, TWO_DAYS, feeds)


def refreshed(spark, sf) -> DayTables:
    """Daily tables built without the late rows, then refreshed where these land."""
    feeds, late = _late(spark, sf)
    store = TableStore(spark)
    root, tables = f"{store.root}/feeds", DayTables(spark, f"{store.root}/daily")
    for name, feed in feeds.items():
        write_feed(feed.where(~late[name]) if name in late else feed, root, name)
    build_daily(spark, root, tables, TWO_DAYS)
    changes = {n: store.put(f"late_{n}", feeds[n].where(late[n])) for n in late}
    days = _middle(spark, sf, 13, 14)
    here = F.col("tap_ts_utc").cast("date").between(days.first, days.last)
    write_feed(feeds["badge_taps"].where(here), root, "badge_taps", replace_days_only=True)
    write_feed(feeds["leave_requests"], root, "leave_requests")
    refresh(spark, root, tables, changes, TWO_DAYS)
    return tables


def _refreshed(name: str) -> Query:
    return lambda spark, sf: refreshed(spark, sf).read(name)


MODELS: dict[str, Query] = {
    "q_workplace_space": _model("stg_workplace_space"),
    "q_workplace_rollup": _model("stg_workplace"),
    "q_city_primary": _model("stg_city_primary_workplace"),
    "q_dim_workplace": _model("dim_workplace"),
    "q_taps_localised": taps_localised,
    "q_taps_deduped": taps_deduped,
    "q_taps_business_day": _model("stg_badge_taps"),
    "q_unknown_site_taps": unknown_site_taps,
    "q_tap_day": _model("int_tap_day"),
    "q_floor_hourly": _model("fct_floor_presence_hourly"),
    "q_hr_typed": _model("stg_hr_employee_snapshot"),
    "q_scd2": _model("int_employee_scd2"),
    "q_dim_employee": _model("dim_employee"),
    "q_leave_staged": _model("stg_leave_requests"),
    "q_leave_days": _model("int_leave_days"),
    "q_travel_staged": _model("stg_travel_bookings"),
    "q_travel_days": _model("int_travel_days"),
    "q_schedule": _model("stg_dept_schedule"),
    "q_population_spine": population_spine,
    "q_employee_day": _model("int_employee_day"),
    "q_state_counts": state_counts,
    "q_state_composition": state_composition,
    "q_dim_date": _model("dim_date"),
    "q_attendance_daily_fact": _model("fct_attendance_daily"),
    "q_capacity_daily_fact": _model("fct_workplace_capacity_daily"),
    **{f"q_metric_{m.name}": metric(m.name, ("region",), m.headline_grain) for m in METRICS.values()},
    "q_metric_day_grain": metric("workstation_waste", ("city", "local_date"), "day"),
    "q_metric_no_dims": metric("attendance_rate", (), "month"),
    "q_metric_by_site": metric("waste_ratio", ("workplace_code", "iso_year_week"), "week"),
    "q_metric_by_department": metric("attendance_rate", ("dept_l1", "dept_l2"), None),
    "q_metric_all_week_filter_off": metric(
        "attendance_daily", ("region", "is_weekend"), "week", include_default_filters=False
    ),
    "q_metric_caller_filter": metric_caller_filter,
    "q_metric_composite_no_keys": metric("seat_demand_rate", (), None),
    "q_metric_composite_own_filter": metric(
        "seat_demand_absolute", ("city",), "month", apply_own_filters=True
    ),
    "q_metric_headlines": metric_headlines,
    "q_rule_violations": rule_violations,
    "q_gates": gates,
    "q_rules_planted": rules_planted,
    "q_gates_planted": gates_planted,
    "q_dq_grain_planted": grain_planted,
    "q_dq_freshness_planted": freshness_planted,
    "q_dq_integrity_planted": integrity_planted,
    "q_contract_landed": contract_landed,
    "q_contract_violations": contract_feeds,
    "q_contract_orders": contract_orders,
    "q_generic_tests": generic_tests,
    "q_generic_tests_retail": generic_tests_retail,
    "q_dq_freshness": _checks(("freshness",)),
    "q_dq_integrity": _checks(("integrity",), "int_employee_day", ATTENDANCE),
    "q_dq_grain": _checks(("grain",), "int_employee_day"),
    "q_dq_legality": _checks(
        (
            "active_after_termination",
            "snapshot_before_hire_date",
            "tap_after_termination",
            "missing_workplace_timezone",
        ),
        "stg_badge_taps",
    ),
    "q_dq_psi": _checks(("attendance_rate_drift",), ATTENDANCE),
    "q_dq_reconcile": _checks(("reconciliation",), "stg_badge_taps", ATTENDANCE),
    "q_dq_volume": _checks(("volume",)),
    "q_dq_samples": quality_samples,
    "q_dq_samples_planted": samples_planted,
    "q_dq_drift_planted": drift_planted,
    "q_dq_details": check_details,
    "q_audit_findings": findings_planted,
    "q_metric_ordered": metric_ordered,
    "q_table_tests_planted": table_tests_planted,
    "q_scorecard": score,
    "q_scorecard_summary": score_summary,
    "q_scorecard_by_category": score_by_category,
    "q_recall": recall,
    "q_supply_ladder": supply_ladder,
    "q_realised_rates": realised_rates,
    "q_recovery": recovery,
    "q_layer_counts": layer_counts,
    "q_measure_audit": measure_audit,
    "q_partitioned_roundtrip": partitioned_roundtrip,
    "q_landed_days": landed_days,
    "q_landed_days_planted": landed_days_planted,
    "q_day_range_rate": ranged_metric("attendance_rate", ("region",), "week"),
    "q_day_range_waste": ranged_metric("waste_ratio", ("city",), "week"),
    "q_affected_days": days_affected,
    "q_day_refresh": _refreshed(ATTENDANCE),
    "q_day_refresh_capacity": _refreshed(CAPACITY),
    "q_day_refresh_floors": _refreshed("fct_floor_presence_hourly"),
}


def _plain_query(query: Query) -> Query:
    return lambda spark, sf: plain(query(spark, sf))


QUERIES: dict[str, Query] = {name: _plain_query(q) for name, q in MODELS.items()}

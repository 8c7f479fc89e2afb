"""The six feeds derived from the retail test tables.

Every row of supplier, customer, orders and events takes part, and only integer arithmetic
decides values, so the derivation grows with the tables and any SQL engine can repeat it.
Residues of the keys plant every case the models tell apart: both directions of the pooled
region, missing zones, re-swipe chains, overnight exits, late reports, unknown sites, overlapping
and reversed leave, postings, joiners, leavers, and people still reported active after leaving.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.measures import label
from rollcall.plans.presence import visible_days, weekday_policy
from rollcall.sources.contracts import CONTRACTS
from rollcall.sources.store import tasks_for

# Region names of the test tables, and the zone of each of their sites.
REGION_CODES = {
    "AMERICA": "AMER",
    "EUROPE": "EMEA",
    "AFRICA": "EMEA",
    "MIDDLE EAST": "APAC",
    "ASIA": "CN",
}
ZONES = {
    "EUROPE": "Europe/Berlin",
    "AFRICA": "Africa/Johannesburg",
    "MIDDLE EAST": "Asia/Dubai",
    "ASIA": "Asia/Shanghai",
}
LEAVE_TYPE_OF = {
    "1-URGENT": "sick",
    "2-HIGH": "annual",
    "3-MEDIUM": "comp",
    "4-NOT SPECIFIED": "unpaid",
    "5-LOW": "parental",
}
LEAVE_STATUS_OF = {"F": "approved", "P": "pending", "O": "cancelled"}
NATIONS = 25


def _person(key: str) -> Column:
    return F.concat(F.lit("E"), F.col(key).cast("string"))


def _site(index: Column) -> Column:
    return F.concat(F.lit("W"), index.cast("string"))


def _plus(day: Column, offset: Column) -> Column:
    return F.date_add(day, offset.cast("int"))


# Stated rather than inferred, so that naming a table runs no job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


class RetailAdapter(Mapping[str, DataFrame]):
    """The feeds by name, each derived when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark = spark
        self._dir = sf_dir

    def __getitem__(self, feed: str) -> DataFrame:
        if feed not in CONTRACTS:
            raise KeyError(feed)
        return getattr(self, feed)()

    def __iter__(self) -> Iterator[str]:
        return iter(CONTRACTS)

    def __len__(self) -> int:
        return len(CONTRACTS)

    @cached_property
    def _constants(self) -> Row:
        """First and last event day and the sizes of the tables: read once, then literals."""
        days = self._table("events").agg(
            F.min("ts").cast("date").alias("start"), F.max("ts").cast("date").alias("end")
        )
        counted = {"supplier": "sites", "customer": "people", "orders": "orders", "events": "taps"}
        counts = (self._table(t).agg(F.count(F.lit(1))).scalar().alias(n) for t, n in counted.items())
        return days.select("start", "end", *counts).first()

    @property
    def _person_days(self) -> int:
        """Rows of the snapshot, at most."""
        c = self._constants
        return c["people"] * ((c["end"] - c["start"]).days + 1) if c["start"] else 0

    def rows(self) -> int:
        """Rows of the daily feeds and of the requests, about."""
        c = self._constants
        return self._person_days + c["taps"] + 2 * c["orders"]

    @property
    def first_day(self) -> date:
        return self._constants["start"]

    @property
    def start(self) -> Column:
        return F.lit(self.first_day)

    @property
    def end(self) -> Column:
        return F.lit(self._constants["end"])

    @property
    def _sites(self) -> Column:
        return F.lit(self._constants["sites"])

    def _table(self, name: str) -> DataFrame:
        return table(self._spark, self._dir, name)

    def workplace_dim(self) -> DataFrame:
        k, floor = F.col("s_suppkey").cast("int"), F.col("floor")
        region = F.col("r_name")
        delivered = F.col("delivered_workstations")
        pool = F.floor(delivered * 20 / 100).cast("int")
        allocated = F.floor(delivered * (45 + k % 33) / 100).cast("int")
        zone = F.when(
            region == "AMERICA",
            F.when(F.col("n_nationkey") % 2 == 0, "America/Los_Angeles").otherwise(
                "America/New_York"
            ),
        ).otherwise(label(region, ZONES))
        floors = (
            self._table("supplier")
            .join(self._table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self._table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .withColumn("floor", F.explode(F.sequence(F.lit(1), 2 + k % 2)))
            .withColumn("delivered_workstations", 3 + (7 * k + 13 * floor) % 13)
        )
        return floors.select(
            _site(k).alias("workplace_code"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("city"),
            F.concat(F.lit("C"), F.floor(F.col("n_nationkey") / 2).cast("string")).alias("country"),
            label(region, REGION_CODES).alias("region"),
            F.when(k % 17 != 3, zone).alias("timezone"),
            F.when(floor == 3, "B").otherwise("A").alias("tower"),
            "floor",
            "delivered_workstations",
            (allocated + F.when(region == "ASIA", pool).otherwise(0)).alias(
                "allocated_workstations"
            ),
            pool.alias("free_sharing_workstations"),
            (delivered * (5 + k % 4) + floor * 0.5).alias("net_workstation_area_sqm"),
            (300.25 + (k * 37) % 400).alias("cost_per_workstation_month"),
            F.date_add(F.lit("2026-01-01").cast("date"), k % 900).alias("lease_expiry_date"),
            ((k + floor) % 5 != 0).alias("is_space_audited"),
        )

    def badge_taps(self) -> DataFrame:
        k, user = F.col("event_id"), F.col("user_id")
        index = (user + F.when(k % 19 == 0, 1).otherwise(0)) % self._sites
        # A re-swipe some seconds later, and for every second such tap one more.
        step = 5 + k % 85
        copies = (
            F.when(k % 194 == 0, F.array(F.lit(0), step, step * 2))
            .when(k % 97 == 0, F.array(F.lit(0), step))
            .otherwise(F.array(F.lit(0).cast("bigint")))
        )
        swiped = self._table("events").withColumn("shift", F.explode(copies))
        ts = F.col("ts") + F.make_dt_interval(secs=F.col("shift"))
        return swiped.select(
            _person("user_id").alias("emp_id"),
            F.when(k % 101 == 7, "W-NONE").otherwise(_site(index)).alias("workplace_code"),
            F.when(k % 5 == 0, "B").otherwise("A").alias("tower"),
            (1 + k % 2).cast("int").alias("floor"),
            ts.alias("tap_ts_utc"),
            F.when(F.col("event_type").isin("purchase", "error"), "out")
            .otherwise("in")
            .alias("direction"),
            F.concat(F.lit("D"), (k % 3).cast("string")).alias("device_id"),
            F.date_add(ts.cast("date"), F.when(k % 33 == 0, 1).otherwise(0)).alias("ingested_date"),
        )

    def people(self) -> DataFrame:
        """Customers with the dates of their employment; the key stays for the residues."""
        k = F.col("c_custkey")
        hire = F.when(k % 11 == 3, _plus(self.start, 3 + k % 17)).otherwise(
            _plus(self.start, -(30 + k % 1000))
        )
        term = F.when(k % 13 == 5, _plus(self.start, k % 20))
        posting = self._table("nation").select(
            F.col("n_nationkey").alias("post_nation"), F.col("n_name").alias("posting_city")
        )
        base = self._table("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("home_city")
        )
        return (
            self._table("customer")
            .withColumn("post_nation", (F.col("c_nationkey") + 7) % NATIONS)
            .join(posting, "post_nation")
            .join(base, "c_nationkey")
            .select("*", hire.alias("hire_date"), term.alias("term_date"))
        )

    def _daily(self) -> DataFrame:
        # Spread the people first: each becomes up to a window's worth of days. The number goes by
        # the rows after the expansion, whereas an adaptive one would go by the size before it.
        tasks = tasks_for(self._spark, self._person_days)
        people = self.people().repartition(tasks, "c_custkey")
        return visible_days(people, self.start, self.end).withColumn(
            "i", F.date_diff("snapshot_date", self.start).cast("bigint")
        )

    def hr_employee_snapshot(self) -> DataFrame:
        k, i, day = F.col("c_custkey"), F.col("i"), F.col("snapshot_date")
        away = (k % 9 == 4) & (i >= k % 15) & (i <= k % 15 + 10)
        left = F.coalesce(day > F.col("term_date"), F.lit(False))
        status = (
            F.when(left & (k % 4 == 1), "active")
            .when(left, F.when(k % 2 == 0, "terminated").otherwise("resigned"))
            .when(day < F.col("hire_date"), F.when(k % 5 == 2, "active").otherwise("onboarding"))
            .when(away, F.when(k % 6 == 0, "pre_assignment").otherwise("on_assignment"))
            .otherwise("active")
        )
        l2 = F.concat("c_mktsegment", F.lit("-"), (F.col("c_nationkey") % 3).cast("string"))
        l3 = F.concat(l2, F.lit("-"), (k % 4).cast("string"))
        types = {0: "FTE", 1: "intern", 2: "contractor", 3: "BPO"}
        badges = {0: "permanent", 1: "temporary", 2: "visitor_escort"}
        boss = (k * 3 + F.floor(i / 11)) % 50
        return self._daily().select(
            "snapshot_date",
            _person("c_custkey").alias("emp_id"),
            status.alias("employment_status"),
            "hire_date",
            "term_date",
            label(k % 3, badges).alias("badge_type"),
            label(k % 4, types).alias("employee_type"),
            F.col("c_mktsegment").alias("dept_l1"),
            l2.alias("dept_l2"),
            l3.alias("dept_l3"),
            F.concat(l3, F.lit("-"), (k % 2).cast("string")).alias("dept_l4"),
            F.when((k + i) % 29 != 0, F.col("home_city")).alias("base_city"),
            _site(k % self._sites).alias("theory_workplace"),
            F.when(k % 50 != 0, F.concat(F.lit("E"), boss.cast("string"))).alias("manager_id"),
            F.when(away, F.col("posting_city")).alias("assignment_city"),
        )

    def dept_schedule(self) -> DataFrame:
        """Policy per division and weekday, expanded from the days it names."""
        part = F.col("c_nationkey") % 3
        kind = (F.length("c_mktsegment") + part) % 3
        days = (
            F.when(kind == 0, F.array(*map(F.lit, (0, 1, 2))))
            .when(kind == 1, F.array(*map(F.lit, (1, 2, 3, 4))))
            .otherwise(F.array(*map(F.lit, (0, 1, 2, 3, 4))))
        )
        # One kind publishes working days only, so its weekends have no policy row.
        published = F.when(kind == 0, F.sequence(F.lit(0), F.lit(4))).otherwise(
            F.sequence(F.lit(0), F.lit(6))
        )
        divisions = (
            self._table("customer")
            .select(
                F.concat("c_mktsegment", F.lit("-"), part.cast("string")).alias("dept_l2"),
                F.col("c_mktsegment").alias("dept_l1"),
                days.alias("office_days"),
                published.alias("published"),
                F.lit("v1").alias("policy_version"),
            )
            .distinct()
        )
        return weekday_policy(divisions, F.col("published"))

    def leave_requests(self) -> DataFrame:
        k = F.col("o_orderkey")
        since = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
        start = _plus(self.start, since % 120 - 45)
        length = F.when(k % 7 == 6, -1).otherwise(k % 5)
        applied = _plus(F.col("start_date"), 3 - k % 20).cast("timestamp_ntz") + F.make_dt_interval(
            hours=k % 24
        )
        return (
            self._table("orders")
            .withColumn("start_date", start)
            .select(
                F.concat(F.lit("L"), k.cast("string")).alias("leave_id"),
                _person("o_custkey").alias("emp_id"),
                label(F.col("o_orderpriority"), LEAVE_TYPE_OF).alias("leave_type"),
                "start_date",
                _plus(F.col("start_date"), length).alias("end_date"),
                label(F.col("o_orderstatus"), LEAVE_STATUS_OF).alias("status"),
                applied.alias("applied_ts"),
            )
        )

    def travel_bookings(self) -> DataFrame:
        k = F.col("o_orderkey")
        nation = self._table("nation").select("n_nationkey", "n_name")
        origin = nation.toDF("origin_nation", "origin_city")
        goal = nation.toDF("goal_nation", "goal_city")
        length = F.when(k % 13 == 12, -1).otherwise(k % 4)
        return (
            self._table("orders")
            .withColumn("origin_nation", (F.col("o_custkey") % NATIONS).cast("int"))
            .withColumn("goal_nation", ((F.col("o_custkey") + k) % NATIONS).cast("int"))
            .join(origin, "origin_nation")
            .join(goal, "goal_nation")
            .withColumn("depart_date", _plus(self.start, (k * 7) % 240 - 100))
            .select(
                F.concat(F.lit("B"), k.cast("string")).alias("booking_id"),
                _person("o_custkey").alias("emp_id"),
                "origin_city",
                F.when(k % 31 == 0, "NOWHERE").otherwise(F.col("goal_city")).alias(
                    "destination_city"
                ),
                "depart_date",
                _plus(F.col("depart_date"), length).alias("return_date"),
                F.when(k % 8 == 0, "cancelled").otherwise("confirmed").alias("booking_status"),
                (k % 2 == 0).alias("hotel_flag"),
                (k % 3 == 0).alias("flight_flag"),
            )
        )

    def planted(self) -> DataFrame:
        """What was planted, counted from the residues alone, as (key, value) rows."""
        k, day = F.col("c_custkey"), F.col("snapshot_date")
        left = F.coalesce(day > F.col("term_date"), F.lit(False))
        hr = self._daily().agg(
            F.count_distinct(F.when(left & (k % 4 == 1), k)).alias(
                "hr_resigned_still_active_employees"
            ),
            F.count_if(
                (day < F.col("hire_date")) & F.when(left, k % 4 == 1).otherwise(k % 5 == 2)
            ).alias("hr_rows_before_hire_date"),
        )
        sites = self._table("supplier").agg(
            F.count_if(F.col("s_suppkey") % 17 == 3).alias("workplace_null_timezone_workplaces")
        )
        leavers = self.people().where("term_date IS NOT NULL").select("c_custkey", "term_date")
        taps = (
            self._table("events")
            .where("event_id % 101 != 7")
            .groupBy(F.col("user_id").alias("c_custkey"))
            .agg(F.max("ts").cast("date").alias("last_day"))
            .join(leavers, "c_custkey")
            .agg(F.count_if(F.col("last_day") > F.col("term_date")).alias("tap_after_termination_employees"))
        )
        return _long(hr).unionByName(_long(sites)).unionByName(_long(taps))


def _long(wide: DataFrame) -> DataFrame:
    counts = wide.select(*(F.col(c).cast("double").alias(c) for c in wide.columns))
    return counts.unpivot([], wide.columns, "key", "value")

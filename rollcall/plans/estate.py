"""The model graph: every table by name, built lazily from the six feeds."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.plans import marts, presence, staging
from rollcall.settings import Settings
from rollcall.sources.contracts import CONTRACTS
from rollcall.sources.days import DayRange, Undated, feed_between, feed_days, parts
from rollcall.sources.store import SessionStore, TableStore, sized, tasks_for

LAYERS: dict[str, tuple[str, ...]] = {
    "raw": tuple(CONTRACTS),
    "staging": (
        "stg_hr_employee_snapshot",
        "stg_badge_taps",
        "stg_leave_requests",
        "stg_travel_bookings",
        "stg_workplace_space",
        "stg_workplace",
        "stg_dept_schedule",
        "stg_city_primary_workplace",
    ),
    "intermediate": (
        "int_employee_scd2",
        "int_leave_days",
        "int_travel_days",
        "int_tap_day",
        "int_employee_day",
    ),
    "marts": (
        "dim_date",
        "dim_employee",
        "dim_workplace",
        "fct_attendance_daily",
        "fct_workplace_capacity_daily",
        "fct_floor_presence_hourly",
    ),
}

# Tables that more than one consumer reads, in dependency order.
SHARED = (
    "stg_badge_taps",
    "int_employee_scd2",
    "int_employee_day",
    "fct_attendance_daily",
    "fct_workplace_capacity_daily",
    "fct_floor_presence_hourly",
)

# Tables with rows of single days, which a day range cuts.
DAILY = (
    "int_employee_day",
    "fct_attendance_daily",
    "fct_workplace_capacity_daily",
    "fct_floor_presence_hourly",
)

# Columns of the employee-day that the facts, rules, checks and declared tests read.
EMPLOYEE_DAY_READ = (
    "emp_id",
    "local_date",
    "dept_l1",
    "dept_l2",
    "employment_status_effective",
    "expected_workplace",
    "is_scheduled_office_day",
    "is_attendance_expected",
    "required_days_per_week",
    "is_on_leave",
    "is_on_travel",
    "is_on_assignment",
    "attended_flag",
    "tap_workplace",
    "span_minutes",
    "has_late_reported_tap",
    "state_rule_id",
    "employee_day_state",
    "is_incumbent",
)


#: Employee-days that are built and written at once. Their shuffles take about 280 bytes of disk for each, at most.
ROWS_AT_ONCE = 20_000_000


class Estate:
    """Names to DataFrames. A table is a lazy plan until `settle` writes it to the store.

    Two tables are stored as soon as they are asked for: the sites and the kept taps. A model
    given along with the feeds (from an earlier run, say) is taken as it is.

    With a range of `days`, the daily tables and what they are made of hold these days only, with
    the rows a run over everything gives them. Day feeds are then read by partition: snapshots of
    the range, taps as far around it as `look` says. History and dimensions stay whole.
    """

    def __init__(
        self,
        spark: SparkSession,
        feeds: Mapping[str, DataFrame],
        settings: Settings | None = None,
        store: TableStore | None = None,
        days: DayRange | None = None,
    ) -> None:
        self.spark = spark
        self.settings = settings or Settings()
        self._store = store
        self._feeds = feeds
        self.days = days
        self._tables: dict[str, DataFrame] = {}
        self._recipes: dict[str, Callable[[], DataFrame]] = self._graph()

    @property
    def store(self) -> TableStore:
        if self._store is None:
            self._store = TableStore(self.spark)
        return self._store

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            given = self._feeds.get(name)
            self._tables[name] = self._recipes[name]() if given is None else given
        return self._tables[name]

    @cached_property
    def rows(self) -> int:
        """Rows of the feeds, which the shuffles are sized by. Files give them from their footers."""
        if hasattr(self._feeds, "rows"):
            return self._feeds.rows()
        total = 0
        for feed in (n for n in CONTRACTS if n in self._feeds):
            ranged = self.days is not None and CONTRACTS[feed].day
            df = feed_between(self._feeds, feed, self.days) if ranged else self._feeds[feed]
            total += df.count()
        return total

    def _tasks(self) -> int | None:
        """Shuffle tasks of a plan that isn't stored at once; None where the session's number is enough."""
        tasks = tasks_for(self.spark, self.rows)
        return None if tasks == tasks_for(self.spark, 0) else tasks

    def put(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """A stored table, written by as many tasks as the feeds ask for."""
        with sized(self.spark, self.rows):
            return self.store.put(name, df, partition_by)

    def settle(self, *names: str) -> Estate:
        """Write tables to the store, so that what is built on them later reads the copies.

        Settle a table before asking for anything that depends on it.
        """
        for name in names:
            self._tables[name] = self.put(name, self[name])
        return self

    def settle_read(self, *names: str) -> Estate:
        """`settle`, with the employee-day in just the columns that facts, rules, checks and declared tests read.

        A stored table hides from its plan which columns are read later, so all 45 would be shuffled, sorted and
        written. Every row is stored; who needs other columns settles the table whole.
        """
        for name in names:
            if name == "int_employee_day":
                self._tables[name] = self[name].select(*EMPLOYEE_DAY_READ)
            self.settle(name)
        return self

    def take(self, name: str, written: DataFrame) -> None:
        """A table read from where it has been written, so that what is built on it doesn't build it again."""
        self._tables[name] = written

    def _cut(self, df: DataFrame, day: str) -> DataFrame:
        return df if self.days is None else df.where(self.days.holds(day))

    def _clipped(self, df: DataFrame, start: str, end: str, part: DayRange | Undated | None = None) -> DataFrame:
        for days in (self.days, part):
            df = df if days is None else days.clipped(df, start, end)
        return df

    def day_parts(self, most: int | None = None) -> list[DayRange | Undated | None]:
        """The days built, in parts of at most so many employee-days, though of a day at least; None is all at once.

        The parts together have every row, those without a day too. The list is calendar-sized.
        """
        most = most or ROWS_AT_ONCE
        made = ("int_employee_day", "int_leave_days", "int_travel_days")
        if self.rows <= most or any(n in self._tables or n in self._feeds for n in made):
            return [None]
        counted = self._snapshot().groupBy("snapshot_date").count().collect()
        rows = {r["snapshot_date"]: r["count"] for r in counted if r["snapshot_date"] is not None}
        whole = self.days or (DayRange(min(rows), max(rows)) if rows else None)
        dated = parts(whole, rows, most) if whole else []
        undated = [Undated()] if len(rows) < len(counted) and self.days is None else []
        return [None] if len(dated) + len(undated) < 2 else [*dated, *undated]

    def of_part(self, name: str, part: DayRange | Undated | None) -> DataFrame:
        """A daily table in a part of its days, with the rows it has for them."""
        if part is None:
            return self[name]
        if name == "int_employee_day" and name not in self._tables:
            return self._employee_days(part)
        return self[name].where(part.holds("local_date"))

    def _employee_days(self, part: DayRange | Undated | None = None) -> DataFrame:
        def cut(df: DataFrame, day: str) -> DataFrame:
            return df if part is None else df.where(part.holds(day))

        return presence.employee_day(
            cut(self._snapshot(), "snapshot_date"),
            self["stg_dept_schedule"],
            self["int_leave_days"] if part is None else self._leave_days(part),
            self["int_travel_days"] if part is None else self._travel_days(part),
            cut(self["int_tap_day"], "local_date"),
            self["stg_city_primary_workplace"],
        )

    def _leave_days(self, part: DayRange | Undated | None = None) -> DataFrame:
        return presence.leave_days(self._clipped(self["stg_leave_requests"], "start_date", "end_date", part))

    def _travel_days(self, part: DayRange | Undated | None = None) -> DataFrame:
        return presence.travel_days(
            self._clipped(self["stg_travel_bookings"], "depart_date", "return_date", part),
            self["stg_city_primary_workplace"],
        )

    def _snapshot(self) -> DataFrame:
        """Snapshots of the days built."""
        if self.days is None:
            return self["stg_hr_employee_snapshot"]
        return staging.hr_snapshot(feed_between(self._feeds, "hr_employee_snapshot", self.days))

    def _taps(self) -> DataFrame:
        """Raw taps that bear on the days built; all, if exits may follow entries of any age."""
        look = self.settings.tap_look()
        if self.days is None or look is None:
            return self["badge_taps"]
        return feed_between(self._feeds, "badge_taps", self.days.widened(*look))

    def _calendar(self) -> DataFrame:
        """A frame whose first and last `snapshot_date` are those of the days built."""
        if self.days is None:
            return self["stg_hr_employee_snapshot"]
        bounds = feed_days(self._feeds, "hr_employee_snapshot").agg(
            F.greatest(F.min("dt"), F.lit(self.days.first)).alias("lo"),
            F.least(F.max("dt"), F.lit(self.days.last)).alias("hi"),
        )
        return bounds.where("lo <= hi").select(F.explode(F.array("lo", "hi")).alias("snapshot_date"))

    def _kept_taps(self) -> DataFrame:
        return staging.kept_taps(
            self._taps(), self["stg_workplace"], self.settings.repeat_window_seconds
        )

    def _hourly_taps(self) -> DataFrame:
        """Taps with local date and hour. The hour needs no business day, so exits need no look-back join, and a plan
        that reads the kept taps once doesn't store them."""
        if "stg_badge_taps" in self._tables and self.days is None:
            return self["stg_badge_taps"]
        kept = self["kept_taps"] if "kept_taps" in self._tables else self._kept_taps()
        return self._cut(staging.local_hours(kept, self["stg_workplace"]), "local_date")

    def _graph(self) -> dict[str, Callable[[], DataFrame]]:
        t, s = self.__getitem__, self.settings
        return {
            "stg_hr_employee_snapshot": lambda: staging.hr_snapshot(t("hr_employee_snapshot")),
            "stg_workplace_space": lambda: staging.workplace_space(t("workplace_dim")),
            # Stored at once: nearly every model joins the sites, and the size of the written
            # table, not an estimate, decides whether such a join is broadcast.
            "stg_workplace": lambda: self.put(
                "stg_workplace", staging.workplace(t("stg_workplace_space"))
            ),
            "stg_city_primary_workplace": lambda: staging.city_primary_workplace(
                t("stg_workplace")
            ),
            "stg_leave_requests": lambda: staging.leave_requests(t("leave_requests")),
            "stg_travel_bookings": lambda: staging.travel_bookings(t("travel_bookings")),
            "stg_dept_schedule": lambda: staging.dept_schedule(t("dept_schedule")),
            # Stored at once: the business day reads the kept taps three times, each time
            # one or both directions, and the shuffle that finds re-swipes must run once.
            "kept_taps": lambda: self.put(
                "kept_taps", self._kept_taps(), partition_by=("direction",)
            ),
            "stg_badge_taps": lambda: self._cut(
                staging.badge_taps(
                    t("kept_taps"), t("stg_workplace"), s.cutover_hour, s.max_anchor_age_days
                ),
                "business_date",
            ),
            "int_employee_scd2": lambda: presence.employee_history(t("stg_hr_employee_snapshot"), self._tasks()),
            "int_leave_days": self._leave_days,
            "int_travel_days": self._travel_days,
            "int_tap_day": lambda: presence.tap_day(t("stg_badge_taps")),
            "int_employee_day": self._employee_days,
            # The snapshot has the days of the employee-day table and is far cheaper to read.
            "dim_date": lambda: marts.dim_date(t("stg_hr_employee_snapshot"), "snapshot_date"),
            "dim_employee": lambda: marts.dim_employee(t("int_employee_scd2"), t("stg_workplace")),
            "dim_workplace": lambda: marts.dim_workplace(t("stg_workplace"), s.pooled_regions),
            "fct_attendance_daily": lambda: marts.fct_attendance_daily(
                t("int_employee_day"), t("stg_workplace")
            ),
            "fct_workplace_capacity_daily": lambda: marts.fct_workplace_capacity_daily(
                t("int_employee_day"),
                t("dim_workplace"),
                self._calendar(),
                "snapshot_date",
            ),
            "fct_floor_presence_hourly": lambda: marts.fct_floor_presence_hourly(self._hourly_taps()),
        }

    def close(self) -> None:
        """Delete the stored tables, unless the session shares them; frames that read them stop working."""
        if self._store is not None and not isinstance(self._store, SessionStore):
            self._store.drop()

    def layer_counts(self) -> DataFrame:
        """Rows of every table, tagged with its layer."""
        parts = [
            self[name]
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(layer).alias("layer"), F.lit(name).alias("table"), "rows")
            for layer, names in LAYERS.items()
            for name in names
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

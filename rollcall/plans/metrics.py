"""The governed metrics and how a request for one becomes a plan.

A metric combines three kinds of aggregation that must not be mixed: its own expression per
site and day, a composition over the days of a period, and an addition over sites. Ratios are
carried as two terms and divided last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import times
from rollcall.functions.measures import available_desks, ratio
from rollcall.settings import Settings

ATTENDANCE = "fct_attendance_daily"
CAPACITY = "fct_workplace_capacity_daily"
SITE, DAY, PERIOD = "workplace_code", "local_date", "period"

PERIODS: dict[str, Callable[[], Column]] = {
    "day": lambda: F.col(DAY),
    "week": lambda: F.col("iso_year_week"),
    "month": lambda: times.month(F.col(DAY)),
}
OVER_DAYS: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "avg": F.avg,
    "max": F.max,
    "min": F.min,
    "last": lambda c: F.max_by(c, F.col(DAY)),
}


class MetricRefused(ValueError):
    """A request the metric's own definition does not allow."""


Expr = Callable[[Settings], Column]


@dataclass(frozen=True)
class Metric:
    name: str
    kind: str  # atomic, derived or composite
    grains: tuple[str, ...]
    dimensions: tuple[str, ...]
    over_days: str
    fact: str | None = None
    value: Expr | None = None
    numerator: Expr | None = None
    denominator: Expr | None = None
    weekdays_only: bool = False
    components: tuple[str, ...] = ()
    formula: Callable[[Mapping[str, Column], Settings], Column] | None = None
    claims: tuple[str, ...] = ()

    @property
    def is_ratio(self) -> bool:
        return self.numerator is not None

    @property
    def is_composite(self) -> bool:
        return self.kind == "composite"

    @property
    def headline_grain(self) -> str:
        return "week" if "week" in self.grains else self.grains[0]

    def terms(self, settings: Settings) -> dict[str, Column]:
        if self.is_ratio:
            return {
                f"{self.name}_numerator": self.numerator(settings),
                f"{self.name}_denominator": self.denominator(settings),
            }
        return {self.name: self.value(settings)}


def _sum(column: str) -> Expr:
    return lambda s: F.sum(column)


def _gap(whole: Expr, part: str) -> Expr:
    return lambda s: whole(s) - F.sum(part)


def _supply(s: Settings) -> Column:
    """Desks on offer, with the regional difference decided per row, inside the sum."""
    return F.sum(
        available_desks(
            F.col("region"),
            F.col("allocated_workstations"),
            F.col("free_sharing_workstations"),
            s.pooled_regions,
        )
    )


def _capacity(*columns: str) -> tuple[str, ...]:
    return tuple(f"{CAPACITY}.{c}" for c in columns)


def _attendance(*columns: str) -> tuple[str, ...]:
    return tuple(f"{ATTENDANCE}.{c}" for c in columns)


ALL_GRAINS = ("day", "week", "month")
SITE_DIMS = (DAY, "iso_year_week", SITE, "city", "region")
WEEKEND_DIMS = (*SITE_DIMS, "is_weekend")
DEPT_DIMS = (*SITE_DIMS, "dept_l1", "dept_l2")
PEAK_DIMS = SITE_DIMS[1:]

METRICS: dict[str, Metric] = {
    m.name: m
    for m in (
        Metric(
            "attendance_daily",
            "atomic",
            ALL_GRAINS,
            WEEKEND_DIMS,
            "avg",
            CAPACITY,
            value=_sum("attendance_actual"),
            weekdays_only=True,
            claims=_capacity("attendance_actual") + _attendance("attendance_daily"),
        ),
        Metric(
            "attendance_rate",
            "derived",
            ALL_GRAINS,
            DEPT_DIMS,
            "avg",
            ATTENDANCE,
            numerator=_sum("attendance_expected_met"),
            denominator=_sum("attendance_expected_days"),
            claims=_attendance("attendance_expected_met", "attendance_expected_days"),
        ),
        Metric(
            "average_unit_workstation_cost",
            "derived",
            ("month",),
            (SITE, "city", "region", "country"),
            "avg",
            CAPACITY,
            numerator=lambda s: F.sum(
                F.col("cost_per_workstation_month") * F.col("delivered_workstations")
            ),
            denominator=_sum("delivered_workstations"),
            claims=_capacity("cost_per_workstation_month", "delivered_workstations"),
        ),
        Metric(
            "floating_headcount",
            "atomic",
            ALL_GRAINS,
            SITE_DIMS,
            "avg",
            CAPACITY,
            value=_sum("floating_headcount"),
            weekdays_only=True,
            claims=_capacity("floating_headcount"),
        ),
        Metric(
            "headcount_incumbent",
            "atomic",
            ALL_GRAINS,
            WEEKEND_DIMS,
            "avg",
            CAPACITY,
            value=_sum("headcount_incumbent"),
            claims=_capacity("headcount_incumbent") + _attendance("headcount_incumbent"),
        ),
        Metric(
            "incumbent_vacancy_rate",
            "derived",
            ALL_GRAINS,
            SITE_DIMS,
            "avg",
            CAPACITY,
            numerator=_gap(_sum("allocated_workstations"), "headcount_incumbent"),
            denominator=_sum("allocated_workstations"),
            weekdays_only=True,
            claims=_capacity("allocated_workstations", "headcount_incumbent"),
        ),
        Metric(
            "peak_day_attendance",
            "derived",
            ("week", "month"),
            PEAK_DIMS,
            "max",
            CAPACITY,
            value=lambda s: F.max("attendance_actual"),
            weekdays_only=True,
            claims=_capacity("attendance_actual"),
        ),
        Metric(
            "scheduled_office_day_compliance_rate",
            "derived",
            ALL_GRAINS,
            DEPT_DIMS,
            "avg",
            ATTENDANCE,
            numerator=_sum("scheduled_attendance"),
            denominator=_sum("scheduled_office_days"),
            claims=_attendance("scheduled_attendance", "scheduled_office_days"),
        ),
        Metric(
            "seat_demand_rate",
            "composite",
            ("week", "month"),
            PEAK_DIMS,
            "max",
            weekdays_only=True,
            components=("peak_day_attendance", "headcount_incumbent"),
            formula=lambda c, s: ratio(c["peak_day_attendance"], c["headcount_incumbent"])
            * (1 + s.seat_demand_buffer),
        ),
        Metric(
            "seat_demand_absolute",
            "composite",
            ("week", "month"),
            PEAK_DIMS,
            "max",
            weekdays_only=True,
            components=("seat_demand_rate", "headcount_incumbent"),
            formula=lambda c, s: c["seat_demand_rate"] * c["headcount_incumbent"],
        ),
        Metric(
            "unallocated_workstation_rate",
            "derived",
            ALL_GRAINS,
            SITE_DIMS,
            "avg",
            CAPACITY,
            numerator=_sum("unallocated_workstations"),
            denominator=_sum("delivered_workstations"),
            claims=_capacity("unallocated_workstations", "delivered_workstations"),
        ),
        Metric(
            "waste_ratio",
            "derived",
            ALL_GRAINS,
            WEEKEND_DIMS,
            "avg",
            CAPACITY,
            numerator=_gap(_supply, "attendance_actual"),
            denominator=_supply,
            weekdays_only=True,
            claims=_capacity(
                "allocated_workstations", "free_sharing_workstations", "attendance_actual"
            ),
        ),
        Metric(
            "workstation_vacancy_rate",
            "derived",
            ALL_GRAINS,
            WEEKEND_DIMS,
            "avg",
            CAPACITY,
            numerator=_gap(_sum("delivered_workstations"), "attendance_actual"),
            denominator=_sum("delivered_workstations"),
            weekdays_only=True,
            claims=_capacity("delivered_workstations", "attendance_actual"),
        ),
        Metric(
            "workstation_waste",
            "atomic",
            ALL_GRAINS,
            WEEKEND_DIMS,
            "avg",
            CAPACITY,
            value=_gap(_supply, "attendance_actual"),
            weekdays_only=True,
            claims=_capacity(
                "workstation_waste",
                "available_workstations",
                "allocated_workstations",
                "free_sharing_workstations",
                "attendance_actual",
            ),
        ),
    )
}


def _unique(names: Iterable[str]) -> list[str]:
    return list(dict.fromkeys(names))


class MetricLayer:
    """Evaluates metrics over facts looked up by name (an `Estate` or a dict of frames)."""

    def __init__(
        self,
        facts: Mapping[str, DataFrame],
        settings: Settings | None = None,
        metrics: Mapping[str, Metric] = METRICS,
    ) -> None:
        self._facts = facts
        self._settings = settings or Settings()
        self._metrics = metrics

    def evaluate(
        self,
        name: str,
        dims: Sequence[str] = (),
        grain: str | None = None,
        filters: Sequence[Column] = (),
        include_default_filters: bool = True,
        apply_own_filters: bool = False,
        ordered: bool = False,
    ) -> DataFrame:
        """(period?, dims..., metric, [numerator, denominator]).

        `include_default_filters=False` lifts a metric's weekday filter. A composite's own
        filter reaches its components only with `apply_own_filters=True`.
        """
        dims = _unique(dims)
        metric = self._check(name, dims, grain)
        if metric.is_composite:
            if apply_own_filters and metric.weekdays_only:
                filters = [*filters, ~F.col("is_weekend")]
            out = self._composite(metric, dims, grain, filters, include_default_filters)
        else:
            out = self._leaf(metric, dims, grain, filters, include_default_filters)
        keys = self._keys(dims, grain)
        return out.orderBy(*keys) if ordered and keys else out

    # -- refusals ---------------------------------------------------------

    def _check(self, name: str, dims: Sequence[str], grain: str | None) -> Metric:
        metric = self._metrics.get(name)
        if metric is None:
            raise MetricRefused(f"unknown metric {name!r}: only registered metrics exist")
        if grain is not None and grain not in metric.grains:
            raise MetricRefused(
                f"{name} is not defined at {grain} grain, only at {', '.join(metric.grains)}"
            )
        if grain is not None and grain not in PERIODS:
            raise MetricRefused(f"unsupported time grain {grain!r}")
        illegal = [d for d in dims if d not in metric.dimensions]
        if illegal:
            raise MetricRefused(
                f"{name} cannot be broken down by {', '.join(illegal)}, "
                f"only by {', '.join(metric.dimensions)}"
            )
        for component in metric.components:
            self._check(component, dims, grain)
        if not metric.is_composite:
            absent = [d for d in dims if d not in self._facts[metric.fact].columns]
            if absent:
                raise MetricRefused(f"{name}: {metric.fact} has no column {', '.join(absent)}")
            if metric.over_days not in OVER_DAYS:
                raise MetricRefused(f"unknown time composition {metric.over_days!r}")
        return metric

    # -- plans ------------------------------------------------------------

    @staticmethod
    def _keys(dims: Sequence[str], grain: str | None) -> list[str]:
        return ([PERIOD] if grain else []) + list(dims)

    def _leaf(self, metric, dims, grain, filters, include_default_filters) -> DataFrame:
        rows = self._facts[metric.fact]
        if include_default_filters and metric.weekdays_only:
            rows = rows.where(~F.col("is_weekend"))
        for predicate in filters:
            rows = rows.where(predicate)
        if grain:
            rows = rows.withColumn(PERIOD, PERIODS[grain]())
        keys = self._keys(dims, grain)
        terms = metric.terms(self._settings)

        per_day = rows.groupBy(*_unique([SITE, DAY, *keys])).agg(
            *(expr.alias(term) for term, expr in terms.items())
        )
        over_days = OVER_DAYS[metric.over_days]
        per_site = per_day.groupBy(*_unique([SITE, *keys])).agg(
            *(over_days(F.col(term)).alias(term) for term in terms)
        )
        total = per_site.groupBy(*keys).agg(*(F.sum(term).alias(term) for term in terms))
        if not metric.is_ratio:
            return total
        numerator, denominator = terms
        value = ratio(F.col(numerator), F.col(denominator)).alias(metric.name)
        return total.select(*keys, value, numerator, denominator)

    def _composite(self, metric, dims, grain, filters, include_default_filters) -> DataFrame:
        """Join each distinct leaf once on the requested keys, then apply the formulas."""
        keys = self._keys(dims, grain)
        names = _unique(self._leaves(metric))
        frames = [
            self._leaf(self._metrics[n], dims, grain, filters, include_default_filters).select(
                *keys, n
            )
            for n in names
        ]
        joined, *rest = frames
        for name, frame in zip(names[1:], rest):
            if keys:
                joined = joined.join(frame, keys)
            else:  # one row each
                joined = joined.select("*", frame.scalar().alias(name))
        return joined.select(*keys, self._formula(metric).alias(metric.name))

    def _leaves(self, metric: Metric) -> list[str]:
        if not metric.is_composite:
            return [metric.name]
        return [leaf for c in metric.components for leaf in self._leaves(self._metrics[c])]

    def _formula(self, metric: Metric) -> Column:
        if not metric.is_composite:
            return F.col(metric.name)
        parts = {c: self._formula(self._metrics[c]) for c in metric.components}
        return metric.formula(parts, self._settings)


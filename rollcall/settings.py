"""Parameters shared by the models, the metrics and the quality checks."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

# Agreed hours of lateness per feed.
FRESHNESS_SLA_HOURS = {
    "hr_employee_snapshot": 26,
    "badge_taps": 50,
    "leave_requests": 26,
    "travel_bookings": 26,
    "workplace_dim": 168,
}


@dataclass(frozen=True)
class Settings:
    """Business parameters. Every default is the published one."""

    repeat_window_seconds: int = 90
    cutover_hour: int = 4
    # An exit follows an entry of at most so many days before; None for however old.
    max_anchor_age_days: int | None = None
    # Regions whose allocated desks already contain the free-sharing pool.
    pooled_regions: tuple[str, ...] = ("CN",)
    seat_demand_buffer: float = 0.10

    freshness_sla_hours: dict[str, int] = field(default_factory=lambda: dict(FRESHNESS_SLA_HOURS))
    psi_warn: float = 0.10
    psi_fail: float = 0.25
    psi_trailing_days: int = 28
    psi_buckets: int = 10
    psi_min_per_bucket: int = 8
    drift_min_expected: int = 20
    reconcile_tolerance: float = 0.005
    volume_z_warn: float = 2.5
    volume_z_fail: float = 4.0
    termination_grace_days: int = 7
    sample_rows: int = 10

    def tap_look(self) -> tuple[int, int] | None:
        """Days by which the UTC day of a tap may lie before and after a business day it bears on; None for no bound.

        A zone moves a tap by less than a day and the cutover by some hours more, together at most one day either way.
        A re-swipe reaches as far as its window. An exit follows an entry up to `max_anchor_age_days` back, so with an
        age limit both sides are bounded, and without one an entry bears on every later day.
        """
        if self.max_anchor_age_days is None:
            return None
        reach = 1 + self.max_anchor_age_days
        return reach + math.ceil(self.repeat_window_seconds / 86_400), reach

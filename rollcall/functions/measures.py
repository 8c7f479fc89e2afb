"""Small arithmetic shared by facts, metrics and checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null, never an error, over zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def label(key: Column, names: dict, otherwise: str | None = None) -> Column:
    """Map fixed keys to names as one CASE expression."""
    out = None
    for value, name in names.items():
        out = F.when(key == value, name) if out is None else out.when(key == value, name)
    return out if otherwise is None else out.otherwise(otherwise)


def available_desks(region: Column, allocated: Column, pool: Column, pooled: Iterable[str]) -> Column:
    """Desks on offer: in a pooled region the sharing pool is already inside allocated."""
    return F.when(region.isin(*pooled), allocated).otherwise(allocated + pool)


def grade(value: Column, warn: float, fail: float, higher_is_worse: bool = True) -> Column:
    """pass / warn / fail against two inclusive thresholds."""
    if higher_is_worse:
        return F.when(value >= fail, "fail").when(value >= warn, "warn").otherwise("pass")
    return F.when(value <= fail, "fail").when(value <= warn, "warn").otherwise("pass")

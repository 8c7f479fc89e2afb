"""Presence analytics as Spark plans: feeds in, governed facts and metrics out."""

from rollcall.plans.estate import Estate
from rollcall.settings import Settings

__all__ = ["Estate", "Settings"]

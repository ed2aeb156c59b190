"""The operators bound to the test tables: one Spark query and one independent SQL text each."""

from goldseam.plans.bound import basics, changes, claims, dashboards, layers, metrics, profiles, scoring  # noqa: F401
from goldseam.plans.bound.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

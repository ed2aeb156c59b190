"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

from goldseam.llm.bound import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

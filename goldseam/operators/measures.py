"""Measures in parts: what lets an aggregate be taken before the joins that its groups need.

A measure says which aggregates of the rows it needs, how those of several parts of a group combine
(by sum, minimum or maximum), and how the combined ones give the result. ``kpi`` can then aggregate a fact to one row per
group of its own columns, join dimensions to these few rows, and combine. The result is that of joining the rows first, also where a
dimension repeats a key: it repeats a part just as it would repeat the part's rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldseam.functions.fixed_point import DECIMALS, as_column, from_limbs, limbs, mean_of, rounded
from goldseam.operators.joins import enrich

COMBINE = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Part:
    rows: Column  # an aggregate over rows
    combine: str = "sum"


@dataclass(frozen=True)
class Measure:
    parts: Mapping[str, Part]
    finish: Callable[[Mapping[str, Column]], Column]

    def of_rows(self) -> Column:
        """The measure as one aggregate over rows."""
        return self.finish({name: part.rows for name, part in self.parts.items()})

    def partial(self, name: str) -> list[Column]:
        return [part.rows.alias(f"{name}:{key}") for key, part in self.parts.items()]

    def combined(self, name: str) -> Column:
        return self.finish({key: COMBINE[part.combine](F.col(f"`{name}:{key}`")) for key, part in self.parts.items()})


def _single(rows: Column, combine: str = "sum", finish: Callable[[Column], Column] = lambda c: c) -> Measure:
    return Measure({"all": Part(rows, combine)}, lambda parts: finish(parts["all"]))


def count_rows() -> Measure:
    return _single(F.count(F.lit(1)))


def count_present(value: Column | str) -> Measure:
    return _single(F.count(as_column(value)))


def count_where(condition: Column) -> Measure:
    """Rows meeting the condition; NULL does not meet it."""
    return _single(F.count(F.when(condition, 1)))


def least(value: Column | str) -> Measure:
    return _single(F.min(as_column(value)), "min")


def greatest(value: Column | str) -> Measure:
    return _single(F.max(as_column(value)), "max")


def _sums(value: Column | str, decimals: int) -> dict[str, Part]:
    return {name: Part(F.sum(limb)) for name, limb in limbs(value, decimals).items()}


def total(value: Column | str, digits: int = 2, decimals: int = DECIMALS) -> Measure:
    """The exact sum, rounded half up to ``digits``."""
    return Measure(_sums(value, decimals), lambda parts: rounded(from_limbs(parts, decimals), digits))


def mean(value: Column | str, digits: int = 2, decimals: int = DECIMALS) -> Measure:
    """The exact mean, rounded half up to ``digits``."""
    parts = {**_sums(value, decimals), "n": Part(F.count(as_column(value)))}
    return Measure(parts, lambda p: mean_of(from_limbs(p, decimals).cast(f"decimal(38,{DECIMALS})"), p["n"], digits))


@dataclass(frozen=True)
class Dimension:
    """A side to join: {fact column: its key}, and the columns to bring (as in ``enrich``).

    A fact column may also be one that an earlier dimension brought.
    """

    frame: DataFrame
    on: Mapping[str, str]
    bring: Mapping[str, str] | Sequence[str]


def combine_after_joins(fact: DataFrame, dimensions: Sequence[Dimension], keys: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    """Measures per ``keys``, which may be columns of the fact or brought by left joins with dimensions.

    The fact is reduced, in its map tasks first, to one row per value of its own keys and join columns; no row of it is
    shuffled for a join. A hot key arrives as a few rows.
    """
    brought = {name for d in dimensions for name in d.bring}
    joining = [column for d in dimensions for column in d.on if column not in brought]
    own = list(dict.fromkeys([k for k in keys if k not in brought] + joining))
    reduced = fact.groupBy(*own).agg(*(part for name, m in measures.items() for part in m.partial(name)))
    for d in dimensions:
        reduced = enrich(reduced, d.frame, d.on, d.bring)
    return reduced.groupBy(*keys).agg(*(m.combined(name).alias(name) for name, m in measures.items()))

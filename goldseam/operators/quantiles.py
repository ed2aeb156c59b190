"""Exact quantiles without a global sort.

``percentile`` keeps every distinct value in one task. Here a mergeable sketch narrows a
bracket around each wanted rank until few enough distinct values are left in it to rank
them exactly. Each round is one scan of the columns asked for and brings one small row to
the driver. The first round keeps about a 2000th of the rows, later ones about a 50th of
what is left, so millions of rows take three scans and 10^13 rows six.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldseam.operators.shaping import FLOATING

_ACCURACY = 10_000  # a sketched rank errs by at most this fraction of the rows
_MARGIN = 2.5 / _ACCURACY  # so the wanted rank lies this close to the sketched one
_STEPS = 100  # grid steps inside a bracket; a step is much wider than the sketch's error
_GRID = [i / _STEPS for i in range(_STEPS + 1)]

Bracket = tuple  # (column, low, high); low and high are None for the whole column


@dataclass
class _Target:
    """A wanted rank (from 0) of a column, and the bracket of values it is known to lie in."""

    column: str
    rank: int
    low: float | None = None
    high: float | None = None
    below: int = 0  # rows under the bracket
    ready: bool = False

    @property
    def bracket(self) -> Bracket:
        return self.column, self.low, self.high

    @property
    def is_one_value(self) -> bool:
        return self.low is not None and self.low == self.high


@dataclass
class _Measure:
    below: int
    inside: int
    distinct: int
    grid: list | None


def _number(df: DataFrame, column: str) -> Column:
    """The column with NaN as NULL."""
    if dict(df.dtypes)[column] in ("float", "double"):
        return F.when(~F.isnan(column), F.col(column))
    return F.col(column)


def _is_inside(value: Column, bracket: Bracket) -> Column:
    _, low, high = bracket
    return value.isNotNull() if low is None else value.between(F.lit(low), F.lit(high))


def _first_brackets(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> tuple[dict[str, int], dict[tuple[str, float], tuple]]:
    """Rows per column, and (low, high) around each quantile, from one scan."""
    around = [min(1.0, max(0.0, p + side)) for p in probs for side in (-_MARGIN, _MARGIN)]
    fields = []
    for i, column in enumerate(columns):
        value = _number(df, column)
        fields += [F.count(value).alias(f"n_{i}"), F.percentile_approx(value, around, _ACCURACY).alias(f"q_{i}")]
    row = df.agg(*fields).first()
    sizes = {column: row[f"n_{i}"] for i, column in enumerate(columns)}
    ends = {
        (column, p): (row[f"q_{i}"][2 * j], row[f"q_{i}"][2 * j + 1])
        for i, column in enumerate(columns)
        if sizes[column]
        for j, p in enumerate(probs)
    }
    return sizes, ends


def _measure(df: DataFrame, brackets: Sequence[Bracket], deep: set[Bracket]) -> dict[Bracket, _Measure]:
    """Rows below and inside each bracket; for deep ones distinct values and a grid too. One scan."""
    fields = []
    for i, bracket in enumerate(brackets):
        column, low, _ = bracket
        value = _number(df, column)
        kept = F.when(_is_inside(value, bracket), value)
        fields.append((F.lit(0) if low is None else F.count(F.when(value < F.lit(low), 1))).alias(f"below_{i}"))
        fields.append(F.count(kept).alias(f"inside_{i}"))
        if bracket in deep:
            fields.append(F.approx_count_distinct(kept).alias(f"distinct_{i}"))
            fields.append(F.percentile_approx(kept, _GRID, _ACCURACY).alias(f"grid_{i}"))
    row = df.agg(*fields).first().asDict()
    return {
        bracket: _Measure(
            row[f"below_{i}"], row[f"inside_{i}"], row.get(f"distinct_{i}", row[f"inside_{i}"]), row.get(f"grid_{i}")
        )
        for i, bracket in enumerate(brackets)
    }


def _narrow(target: _Target, seen: _Measure, few: int) -> None:
    """Use a measure of the target's bracket: settle the target, or move its bracket."""
    if not seen.below <= target.rank < seen.below + seen.inside:
        if target.low is None:
            raise RuntimeError(f"rank {target.rank} is not among the values of {target.column}")
        target.low = target.high = None  # a sketch of a handful of rows may miss a neighbour
        return
    target.below = seen.below
    if target.is_one_value or min(seen.inside, seen.distinct) <= few:
        target.ready = True
    elif seen.grid:
        step = (target.rank - seen.below) * _STEPS / seen.inside
        target.low = seen.grid[max(0, math.floor(step) - 1)]
        target.high = seen.grid[min(_STEPS, math.ceil(step) + 1)]


def _typed(value, kind: str):
    """A picked value in the column's own type."""
    if kind.startswith("decimal"):
        digits = int(kind.rstrip(")").split(",")[1])
        return Decimal(value).quantize(Decimal(1).scaleb(-digits))
    return value if kind in FLOATING else int(value)


def _pick(df: DataFrame, targets: Sequence[_Target]) -> dict[tuple[str, int], float]:
    """{(column, rank): value}: the values inside the brackets, counted and ranked."""
    kinds = dict(df.dtypes)
    picked = {(t.column, t.rank): t.low for t in targets if t.is_one_value}
    ranked = [t for t in targets if not t.is_one_value]
    if not ranked:
        return picked
    brackets = sorted({t.bracket for t in ranked}, key=str)
    entries, anywhere = [], F.lit(False)
    for i, bracket in enumerate(brackets):
        value = _number(df, bracket[0])
        inside = _is_inside(value, bracket)
        anywhere = anywhere | inside
        # Numbers without a floating point stay as they are: a double cannot tell large ones apart.
        whole = F.lit(None) if kinds[bracket[0]] in FLOATING else value
        fields = (F.lit(i).alias("bracket"), value.cast("double").alias("value"), whole.cast("decimal(38,18)").alias("whole"))
        entries.append(F.when(inside, F.struct(*fields)))
    counted = (
        df.filter(anywhere)
        .select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
        .groupBy("e.bracket", "e.value", "e.whole")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("bracket").orderBy("value", "whole"))
    hit = F.lit(False)
    for t in ranked:
        place = t.rank - t.below
        covers = (F.col("upto") > place) & (F.col("upto") - F.col("n") <= place)
        hit = hit | ((F.col("bracket") == brackets.index(t.bracket)) & covers)
    for row in counted.withColumn("upto", upto).filter(hit).collect():
        for t in ranked:
            if brackets[row["bracket"]] == t.bracket and row["upto"] - row["n"] <= t.rank - t.below < row["upto"]:
                picked[t.column, t.rank] = _typed(row["value"] if row["whole"] is None else row["whole"], kinds[t.column])
    return picked


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], continuous: bool = False, few: int = 100_000
) -> dict[str, list[float | None]]:
    """{column: [quantile per prob]}, NULL and NaN left out; None for a column without values.

    Discrete quantiles are elements of the column (the smallest with at least that share
    of the rows at or below it); continuous ones interpolate between two neighbours.
    ``few`` is how many distinct values of a bracket one task may rank.
    """
    sizes, ends = _first_brackets(df, columns, probs)
    # The neighbours of each quantile and how far it lies between them.
    places: dict[tuple[str, float], tuple[int, int, float]] = {}
    targets: dict[tuple[str, int], _Target] = {}
    for (column, p), (low, high) in ends.items():
        n = sizes[column]
        at = p * (n - 1) if continuous else max(0, math.ceil(p * n) - 1)
        places[column, p] = (math.floor(at), math.ceil(at), at - math.floor(at))
        for rank in places[column, p][:2]:
            targets[column, rank] = _Target(column, rank, low, high)
    deep: set[Bracket] = set()
    while True:
        unsettled = [t for t in targets.values() if not t.ready]
        if not unsettled:
            break
        brackets = sorted({t.bracket for t in unsettled}, key=str)
        # A grid is worth its cost where the rows in the bracket are known to be many.
        expected = {b for b in brackets if sizes[b[0]] * 2 * _MARGIN > few and b[1] != b[2]}
        measures = _measure(df, brackets, deep | expected)
        for target in unsettled:
            _narrow(target, measures[target.bracket], few)
        deep = {t.bracket for t in unsettled if not t.ready}
    picked = _pick(df, list(targets.values()))

    def value(column: str, p: float) -> float | None:
        if (column, p) not in places:
            return None
        lo, hi, share = places[column, p]
        low, high = picked[column, lo], picked[column, hi]
        if not share or low == high:
            return low
        return low + (high - low) * (Decimal(share) if isinstance(low, Decimal) else share)

    return {column: [value(column, p) for p in probs] for column in columns}


# Rank error of a KLL sketch of size k, at 99 percent confidence, is A / k ** B; and the sizes that Spark takes.
KLL_A, KLL_B, KLL_SIZES = 2.296, 0.9021, (8, 65_535)


def sketch_size(rel_error: float) -> int:
    """The size of a KLL sketch whose ranks are off by at most that share of the rows, at 99 percent confidence."""
    least, most = KLL_SIZES
    size = math.ceil((KLL_A / rel_error) ** (1 / KLL_B))
    if size > most:
        raise ValueError(f"no sketch is as close as {rel_error}; take exact quantiles")
    return max(least, size)


def quantile_sketches(df: DataFrame, keys: Sequence[str], columns: Sequence[str], rel_error: float = 0.01) -> DataFrame:
    """Per group a mergeable sketch of each numeric column, in one scan; NULL and NaN are left out.

    Groups may be as fine as days or files: ``quantiles_from_sketches`` merges them without the rows.
    """
    size = sketch_size(rel_error)
    made = [F.kll_sketch_agg_double(_number(df, c).cast("double"), size).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*made)


def quantiles_from_sketches(sketches: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Per (coarser) group an array of quantiles of each column; NULL where a group has no value of it."""
    wanted = F.array(*(F.lit(float(p)) for p in probs))

    def read(column: str) -> Column:
        merged = F.kll_merge_agg_double(column)
        return F.when(F.kll_sketch_get_n_double(merged) > 0, F.kll_sketch_get_quantile_double(merged, wanted)).alias(column)

    return sketches.groupBy(*keys).agg(*(read(c) for c in columns))


def sketched_quantiles(df: DataFrame, column: str, probs: Sequence[float], rel_error: float) -> Column:
    """Aggregate: an array of quantiles whose ranks are off by at most ``rel_error`` of the rows; NULL without values.

    An aggregate like any other, so it shares the scan with counts, means and extremes.
    """
    sketch = F.kll_sketch_agg_double(_number(df, column).cast("double"), sketch_size(rel_error))
    found = F.kll_sketch_get_quantile_double(sketch, F.array(*(F.lit(float(p)) for p in probs)))
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, found)

"""Scores of a classifier: tiers, softmax, best class, top classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldseam.functions.fixed_point import as_column

# Tier names and their lower bounds.
HIGH, MIDDLE, LOW = "alta", "media", "baja"
HIGH_FROM, MIDDLE_FROM = 0.8, 0.5


def confidence_tier(score: Column | str, high: float = HIGH_FROM, mid: float = MIDDLE_FROM) -> Column:
    """alta / media / baja; a missing score is baja."""
    value = as_column(score)
    return F.when(value >= high, HIGH).when(value >= mid, MIDDLE).otherwise(LOW)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, also when used inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def softmax(logits: Column | str) -> Column:
    """Class probabilities of an array of logits."""
    values = F.transform(as_column(logits), lambda x: x.cast("double"))

    def shares(powers: Column) -> Column:
        total = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
        return _bind(total, lambda t: F.transform(powers, lambda x: x / t))

    return _bind(
        F.array_max(values),
        lambda peak: _bind(F.transform(values, lambda x: F.exp(x - peak)), shares),
    )


def argmax(values: Column | str) -> Column:
    """Position (from 0) of the first largest element."""
    array = as_column(values)
    return (F.array_position(array, F.array_max(array)) - 1).cast("int")


def label_at(labels: Sequence[str], position: Column) -> Column:
    """The label at a 0-based position."""
    return F.get(F.array(*(F.lit(label) for label in labels)), position)


def top_positions(values: Column | str, k: int) -> Column:
    """0-based positions of the k largest elements, largest first, ties by position.

    Works inside each row; nothing is shuffled.
    """
    array = as_column(values)
    # Sorting ascending on (-value, position) keeps the cheap default ordering of structs.
    keyed = F.transform(array, lambda x, i: F.struct((-x).alias("neg"), i.alias("pos")))
    return F.transform(F.slice(F.array_sort(keyed), 1, k), lambda s: s["pos"])


def top_k(scores: Column | str, k: int) -> Column:
    """The k best (label, score) entries of a map of scores, best first, ties by label."""
    entries = F.transform(
        F.map_entries(as_column(scores)),
        lambda e: F.struct((-e["value"]).alias("neg"), e["key"].alias("label")),
    )
    best = F.slice(F.array_sort(entries), 1, k)
    return F.transform(best, lambda s: F.struct(s["label"].alias("label"), (-s["neg"]).alias("score")))

"""Joins that enrich a fact, and checks on how well two frames join.

Spark broadcasts a side when its size is known to be below ``autoBroadcastJoinThreshold``;
above that it shuffles both sides, and adaptive execution splits a partition that one hot
key makes too large. It cannot do so when a side comes straight out of an aggregate on the
join key, as that side needs no shuffle of its own. For those joins find the ``hot_keys``
of the fact by a sketch and pass them on: their rows then meet a broadcast of the few rows that belong
to these keys, and are not shuffled at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldseam.functions.fixed_point import percent


def hot_keys(df: DataFrame, key: str, share: float = 1e-4, min_rows: int = 1_000_000) -> list:
    """Values of ``key`` (None for NULL) that hold at least ``min_rows`` and more than a share of all rows.

    One scan of the key column. Every task keeps a sketch of its heaviest keys, of a size that depends on ``share`` only, and the
    sketches merge; nothing is shuffled by key. It tracks four keys per share, so no key above the share is missed; its counts
    are close, not exact, so a key near the limit may be found or not. A join has the same result either way.
    """
    most = int(1 / share)
    tracked = min(1_000_000, max(64, 4 * most))
    # The name is quoted as text of an expression; the sketch has no function in Python yet.
    column = "`" + key.replace("`", "``") + "`"
    sketch = F.expr(f"approx_top_k({column}, {min(most, tracked)}, {tracked})")
    found = df.agg(sketch.alias("top"), F.count(F.lit(1)).alias("n")).first()
    least = max(min_rows, found["n"] * share)
    return [entry["item"] for entry in found["top"] or [] if entry["count"] >= least]


def _among(key: Column, values: Sequence) -> Column:
    """True or False, also for a NULL key."""
    given = [v for v in values if v is not None]
    found = F.coalesce(key.isin(given), F.lit(False)) if given else F.lit(False)
    return found | key.isNull() if len(given) < len(values) else found


#: Rows that a side may have for hot keys to be broadcast.
FEW_ROWS = 100_000


def _split_join(left: DataFrame, left_key: str, right: DataFrame, right_key: str, how: str, hot: Sequence) -> DataFrame:
    """``left`` joined with ``right``, whose rows of hot keys are broadcast if they are few.

    A side that repeats hot keys too often for that does not come out of an aggregate on the key, so both sides are
    shuffled, and adaptive execution splits the hot partitions of the plain join.
    """
    match = left[left_key] == right[right_key]
    few = right.filter(_among(right[right_key], hot)) if hot else None
    if few is None or few.select(F.lit(1)).limit(FEW_ROWS + 1).count() > FEW_ROWS:
        return left.join(right, match, how)
    few = F.broadcast(few)
    is_hot = _among(left[left_key], hot)
    return left.filter(is_hot).join(few, match, how).unionByName(left.filter(~is_hot).join(right, match, how))


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    bring: Mapping[str, str] | Sequence[str],
    how: str = "left",
    hot: Sequence = (),
) -> DataFrame:
    """``fact`` with columns of ``dim`` joined on {fact column: dim column}.

    ``bring`` lists the dim columns to add, or maps new names to them. Keys of both sides
    may have any names, also the same; the dim's keys are not kept unless brought. With
    ``hot`` keys the join must be on one column.
    """
    if not isinstance(bring, Mapping):
        bring = {name: name for name in bring}
    keys = {f"_key_{i}": pair for i, pair in enumerate(on.items())}
    side = dim.select(
        *(F.col(dim_key).alias(name) for name, (_, dim_key) in keys.items()),
        *(F.col(source).alias(name) for name, source in bring.items()),
    )
    if hot:
        ((name, (fact_key, _)),) = keys.items()
        return _split_join(fact, fact_key, side, name, how, hot).drop(name)
    matches = [fact[fact_key] == side[name] for name, (fact_key, _) in keys.items()]
    return fact.join(side, matches, how).drop(*keys)


def orphans(df: DataFrame, other: DataFrame, key: str, hot: Sequence = ()) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``; rows with a NULL key are orphans too.

    Distinct keys of ``other`` shrink in the map tasks, so a hot key there costs one row
    each. Pass the hot keys of ``df``, if any.
    """
    known = other.select(F.col(key).alias("_known")).distinct()
    return _split_join(df, key, known, "_known", "left_anti", hot)


def _key_sizes(df: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias(name))


def join_coverage(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row: total, matched, unmatched rows of ``df`` and the matched percentage.

    Both sides are reduced to one row per key before they meet.
    """
    sizes = _key_sizes(df, on, "rows")
    known = other.select(*on).distinct().withColumn("_known", F.lit(True))
    totals = sizes.join(known, list(on), "left").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("_known"), F.col("rows"))), F.lit(0)).alias("matched"),
    )
    return totals.select(
        "total",
        "matched",
        (F.col("total") - F.col("matched")).alias("unmatched"),
        percent(F.col("matched"), F.col("total")).alias("matched_pct"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_as: str = "copies") -> DataFrame:
    """Keys held by more than one row: the reason a join on them multiplies rows."""
    return _key_sizes(df, keys, count_as).filter(F.col(count_as) > 1)


def fan_out(rows_in: DataFrame, rows_out: DataFrame) -> DataFrame:
    """One row: the rows before and after a join and how many it added."""
    counted: list[Column] = [
        df.agg(F.count(F.lit(1)).alias("n")).scalar().alias(name)
        for name, df in (("rows_in", rows_in), ("rows_out", rows_out))
    ]
    one = rows_in.sparkSession.range(1).select(*counted)
    return one.withColumn("added", F.col("rows_out") - F.col("rows_in"))

"""Grouped measures, distributions, best rows per key and cross tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldseam.functions.fixed_point import as_column, exact_mean, exact_sum, percent
from goldseam.operators.measures import Dimension, Measure, combine_after_joins


def rows() -> Column:
    return F.count(F.lit(1))


def present(value: Column | str) -> Column:
    """Rows whose value is not NULL."""
    return F.count(as_column(value))


def count_where(condition: Column) -> Column:
    """Rows meeting the condition; NULL does not meet it."""
    return F.count(F.when(condition, 1))


def mean(value: Column | str, digits: int = 2, exact: bool = False) -> Column:
    """Rounded mean; ``exact`` ones do not depend on the order of rows."""
    return exact_mean(value, digits) if exact else F.round(F.avg(as_column(value)), digits)


def total(value: Column | str, digits: int = 2, exact: bool = False) -> Column:
    """Rounded sum; ``exact`` ones do not depend on the order of rows."""
    return exact_sum(value, digits) if exact else F.round(F.sum(as_column(value)), digits)


def kpi(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Mapping[str, Column | Measure],
    percentages: Mapping[str, tuple[str, str]] | None = None,
    dimensions: Sequence[Dimension] = (),
) -> DataFrame:
    """Grouped measures {name: aggregate}, then {name: (part, total)} as percentages of them.

    With ``dimensions``, keys may be columns of theirs, and all metrics are measures in parts: the
    rows are aggregated before they are joined.
    """
    if dimensions:
        measured = combine_after_joins(df, dimensions, keys, metrics)
    else:
        plain = {name: metric.of_rows() if isinstance(metric, Measure) else metric for name, metric in metrics.items()}
        measured = df.groupBy(*keys).agg(*(metric.alias(name) for name, metric in plain.items()))
    shares = {name: percent(F.col(a), F.col(b)) for name, (a, b) in (percentages or {}).items()}
    return measured.withColumns(shares) if shares else measured


def count_by(df: DataFrame, keys: Sequence[str], count_as: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(rows().alias(count_as))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def class_distribution(df: DataFrame, column: str, minority_below: float = 5.0) -> DataFrame:
    """Rows and percentage per class, the smallest percentage, and a minority flag.

    The total is a scalar subquery over the counts, which reuses their shuffle; a window
    over all classes would pull them into one task.
    """
    counts = count_by(df, [column])
    overall = F.struct(F.sum("n").alias("rows"), F.min("n").alias("least"))
    summary = counts.agg(overall.alias("s")).scalar()
    pct = percent(F.col("n"), summary["rows"])
    return counts.select(
        column,
        "n",
        pct.alias("pct"),
        (pct < minority_below).alias("is_minority"),
        percent(summary["least"], summary["rows"]).alias("smallest_pct"),
    )


def best_by(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    score: str,
    tie_break: Sequence[str],
    metrics: Mapping[str, Column] | None = None,
    beside: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per key the value of the row with the highest score, with further aggregates.

    ``beside`` are other columns of that same row. Rows without a value do not compete, so a key without any
    has NULL in all of them. Ties go to the largest ``tie_break``, so the answer does not depend on the order of the rows.
    """
    rank = F.when(F.col(value).isNotNull(), F.struct(score, *tie_break))
    fields = {value: F.col(value), **(beside or {})}
    extra = (metric.alias(name) for name, metric in (metrics or {}).items())
    best = F.max_by(F.struct(*(column.alias(name) for name, column in fields.items())), rank)
    found = df.groupBy(*keys).agg(best.alias("_best"), *extra)
    return found.select(*keys, *(F.col("_best")[name].alias(name) for name in fields), *(metrics or {}))


def overview(
    df: DataFrame,
    measures: Mapping[str, Column],
    distinct: Mapping[str, str] | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """One row: aggregates {name: measure}, and numbers of distinct values {name: column}.

    Each set of distinct values is counted by its own narrow aggregate. Several distinct counts in one
    aggregate would copy every row once per set.
    """
    counted = {
        name: df.select(column).where(F.col(column).isNotNull()).distinct().agg(rows()).scalar()
        for name, column in (distinct or {}).items()
    }
    whole = df.agg(*(measure.alias(name) for name, measure in measures.items()))
    names = order or [*measures, *counted]
    return whole.select(*(counted[name].alias(name) if name in counted else F.col(name) for name in names))


def distinct_sketches(df: DataFrame, keys: Sequence[str], column: str, precision: int = 12, sketch_as: str = "sketch") -> DataFrame:
    """Per group a sketch of the distinct values of a column, to be stored and merged later over any groups.

    A sketch has at most 2^``precision`` bytes or so; its relative standard error is about 1.04 / sqrt(2^precision). NULLs do not count.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(column), precision).alias(sketch_as))


def distinct_from_sketches(sketches: DataFrame, keys: Sequence[str], sketch: str = "sketch", count_as: str = "n") -> DataFrame:
    """Estimated distinct values per (coarser) group, from stored sketches alone."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(count_as))


def distinct_list(value: Column | str, sep: str = ",") -> Column:
    """Aggregate: the distinct values as sorted, joined text. For columns of few values."""
    return F.array_join(F.sort_array(F.collect_set(as_column(value))), sep)


def top_groups(df: DataFrame, key: str, metric: Column, k: int, name: str = "total") -> DataFrame:
    """The k groups with the largest metric; rows with a NULL key are left out."""
    grouped = df.filter(F.col(key).isNotNull()).groupBy(key).agg(metric.alias(name))
    return grouped.orderBy(F.desc_nulls_last(name), F.asc(key)).limit(k)


def _per_category(
    df: DataFrame, column: str, categories: Sequence[str], metrics: Mapping[str, Callable[[Column], Column]]
) -> DataFrame:
    """One row per listed category, in one global aggregate: no group, join or sort is needed.

    A metric gets the condition "row is in the category" and returns an aggregate.
    """
    entries = []
    for place, category in enumerate(categories):
        inside = F.col(column) == category
        fields = [metric(inside).alias(name) for name, metric in metrics.items()]
        entries.append(F.struct(F.lit(place).alias("place"), F.lit(category).alias(column), *fields))
    return df.agg(F.array(*entries).alias("rows")).select(F.inline("rows"))


def counts_with_categories(df: DataFrame, column: str, categories: Sequence[str], count_as: str = "n") -> DataFrame:
    """Row counts of the listed categories in list order, zero where there are none."""
    return _per_category(df, column, categories, {count_as: count_where})


def measures_with_categories(
    df: DataFrame, column: str, categories: Sequence[str], value: Column, digits: int = 2
) -> DataFrame:
    """Mean and sum of a value for the listed categories in list order."""
    metrics = {
        "mean_value": lambda inside: exact_mean(F.when(inside, value), digits),
        "total_value": lambda inside: exact_sum(F.when(inside, value), digits),
    }
    return _per_category(df, column, categories, metrics)


def cross_counts(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Row counts of ``row`` by the listed values of ``column``, zero where there are none."""
    counted = df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1)))
    placed = counted.toDF(row, *(f"_{place}" for place in range(len(values))))  # a value may be named like a column
    return placed.select(row, *(F.coalesce(f"_{place}", F.lit(0)).alias(value) for place, value in enumerate(values)))

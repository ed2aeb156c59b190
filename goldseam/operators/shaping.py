"""Column typing, projections, row filters and keyed deduplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldseam.functions.text import is_blank


FLOATING = ("double", "float", "real")


def finite(value: Column) -> Column:
    """A floating number, or NULL for NaN and infinity."""
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def conform(df: DataFrame, types: Mapping[str, str], stamp: str | None = None) -> DataFrame:
    """Cast columns to their declared types; text that does not fit becomes NULL, and so do NaN and infinity.

    Columns without a declared type pass unchanged. ``stamp`` names a column for the
    time of ingestion.
    """
    changed = {}
    for name, to_type in types.items():
        value = F.col(name).try_cast(to_type)
        changed[name] = finite(value) if to_type.lower() in FLOATING else value
    if stamp:
        changed[stamp] = F.current_timestamp()
    return df.withColumns(changed)


def typed_projection(df: DataFrame, contract: Mapping[str, tuple[Column, str]]) -> DataFrame:
    """Exactly the contract's columns: {name: (expression, type)}."""
    return df.select(*(expr.cast(to_type).alias(name) for name, (expr, to_type) in contract.items()))


def keep_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Those of ``columns`` that exist, in the order asked for."""
    have = set(df.columns)
    return df.select(*(name for name in columns if name in have))


def drop_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Without those of ``columns`` that exist."""
    have = set(df.columns)
    return df.drop(*(name for name in columns if name in have))


def other_columns(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [name for name in df.columns if name not in set(keys)]


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every column; plain conditions, which the scan can use."""
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
    return df


def not_blank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose text columns hold more than spaces."""
    for name in columns:
        df = df.filter(~is_blank(name))
    return df


def valid_range(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    """Rows with every column inside its (low, high); None leaves a side open.

    NULL fails, and so do NaN, which would sort above every number, and infinity.
    """
    kinds = dict(df.dtypes)
    for name, (low, high) in bounds.items():
        df = df.filter(F.col(name).isNotNull())
        if kinds[name] in FLOATING:
            df = df.filter(~F.isnan(name))
            df = df.filter((F.col(name) > float("-inf")) & (F.col(name) < float("inf")))
        if low is not None:
            df = df.filter(F.col(name) >= low)
        if high is not None:
            df = df.filter(F.col(name) <= high)
    return df


def in_order(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Rows where ``earlier`` is not after ``later``; a NULL on either side fails."""
    return df.filter(F.col(earlier) <= F.col(later))


def filter_by(df: DataFrame, **equals) -> DataFrame:
    """Rows equal to every given value; the value "All" leaves its column unfiltered."""
    for name, value in equals.items():
        if value != "All":
            df = df.filter(F.col(name) == value)
    return df


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first by ``order_by``, further ties by all other columns.

    NULL keys form one group. Spark keeps one row per key within each map task
    (WindowGroupLimit) before it shuffles, so copies of a hot key never meet in one task.
    """
    plain = []
    for field in df.schema.fields:
        if field.name in set(keys):
            continue
        kind = field.dataType.simpleString()
        if kind.startswith("map<") and "map<" not in kind[4:]:  # maps have no order, their sorted entries do
            plain.append(F.array_sort(F.map_entries(field.name)).desc_nulls_last())
        elif "map<" not in kind:
            plain.append(F.col(field.name).desc_nulls_last())
    ranked = Window.partitionBy(*keys).orderBy(*order_by, *plain)
    return df.withColumn("_place", F.row_number().over(ranked)).filter("_place = 1").drop("_place")


def sample_rows(df: DataFrame, columns: Sequence[str], order_by: Sequence[Column], n: int) -> DataFrame:
    """The first n rows by a total order: a listing for people, the same on each run."""
    return df.orderBy(*order_by).limit(n).select(*columns)

"""Data-quality reports and the gates that raise on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldseam.functions.fixed_point import percent, plain_zero


def quality_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, failures, total, failed_pct) for all rules in one pass.

    A rule is the condition of a failing row; NULL is not a failure.
    """
    n_rows = F.count(F.lit(1))
    entries = []
    for name, fails in rules.items():
        failures = F.count(F.when(fails, 1))
        entries.append(
            F.struct(
                F.lit(name).alias("rule"),
                failures.alias("failures"),
                n_rows.alias("total"),
                percent(failures, n_rows).alias("failed_pct"),
            )
        )
    return df.agg(F.array(*entries).alias("rows")).select(F.inline("rows"))


def key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, rows with a NULL in the key, keys held by several rows, surplus rows."""
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    repeated = F.col("copies") > 1
    zero = F.lit(0).cast("bigint")
    return sizes.agg(
        F.coalesce(F.sum("copies"), zero).alias("n_rows"),
        F.coalesce(F.sum(F.when(any_null, F.col("copies"))), zero).alias("null_key_rows"),
        F.count(F.when(repeated, 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("copies") - 1)), zero).alias("surplus_rows"),
    )


def value_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, min_value, max_value) of numeric columns in one pass."""
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            plain_zero(F.min(F.col(c).cast("double"))).alias("min_value"),
            plain_zero(F.max(F.col(c).cast("double"))).alias("max_value"),
        )
        for c in columns
    ]
    return df.agg(F.array(*entries).alias("rows")).select(F.inline("rows"))


def key_coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, present, missing, present_pct) in one pass."""
    n_rows = F.count(F.lit(1))
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("present"),
            (n_rows - F.count(c)).alias("missing"),
            percent(F.count(c), n_rows).alias("present_pct"),
        )
        for c in columns
    ]
    return df.agg(F.array(*entries).alias("rows")).select(F.inline("rows"))


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error naming the columns it lacks."""
    lacking = missing_columns(df, columns)
    if lacking:
        raise ValueError(f"missing columns: {', '.join(lacking)}")
    return df


def type_mismatches(df: DataFrame, types: Mapping[str, str]) -> list[tuple[str, str, str | None]]:
    """(column, expected type, found type) where the schema breaks the contract."""
    found = dict(df.dtypes)
    return [(c, t, found.get(c)) for c, t in types.items() if found.get(c) != t]


def require_rows(df: DataFrame) -> DataFrame:
    """``df`` itself, or an error when it has no row. Reads at most one row."""
    if df.isEmpty():
        raise ValueError("the frame has no rows")
    return df


def assert_quality(report: DataFrame, max_failures: int = 0) -> None:
    """Raise with the rules of a report that fail more often than allowed."""
    broken = report.filter(F.col("failures") > max_failures).select("rule", "failures").collect()
    if broken:
        raise ValueError("; ".join(f"{r['rule']}: {r['failures']} rows" for r in broken))


def is_ready(report: DataFrame) -> bool:
    """True when the frame had rows and no rule failed."""
    verdict = report.agg((F.min("total") > 0) & (F.max("failures") == 0)).first()[0]
    return bool(verdict)


def missing_content(df: DataFrame, columns: Sequence[str], content: str = "content", n: int = 10) -> DataFrame:
    """A listing of up to n rows whose binary content is missing."""
    return df.filter(F.col(content).isNull()).select(*columns).orderBy(*columns).limit(n)

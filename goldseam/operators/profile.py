"""Exploratory statistics: shape, missing values, summaries, correlation, outliers, histograms."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from goldseam.functions.fixed_point import plain_zero
from goldseam.operators.quantiles import exact_quantiles, sketched_quantiles
from goldseam.operators.shaping import finite, not_null

DIGITS = 6


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _long_form(df: DataFrame, entries: Sequence) -> DataFrame:
    """One aggregate over ``df`` whose structs become the rows of the result."""
    return df.agg(F.array(*entries).alias("rows")).select(F.inline("rows"))


def profile_shape(df: DataFrame) -> DataFrame:
    """(column_name, column_type, n_columns, n_rows), one row per column."""
    names = F.array(*(F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("column_type")) for n, t in df.dtypes))
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(F.inline(names), F.lit(len(df.columns)).alias("n_columns"), "n_rows")


def null_profile(df: DataFrame) -> DataFrame:
    """NULLs of every column and NaNs of the floating ones, in one pass."""
    entries = []
    for field in df.schema.fields:
        value = F.col(field.name)
        floating = isinstance(field.dataType, (DoubleType, FloatType))
        n_nan = F.count(F.when(F.isnan(value), 1)) if floating else F.lit(0).cast("bigint")
        entries.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.count(F.when(value.isNull(), 1)).alias("n_null"),
                n_nan.alias("n_nan"),
                F.count(F.lit(1)).alias("n_rows"),
            )
        )
    return _long_form(df, entries)


def _statistics(column: str, quartiles: Sequence[float | Column | None] | None) -> list:
    value = F.col(column).cast("double")
    fields = [
        F.lit(column).alias("column_name"),
        F.count(value).alias("n"),
        F.round(F.avg(value), DIGITS).alias("mean"),
        F.round(F.stddev(value), DIGITS).alias("stddev"),
        plain_zero(F.min(value)).alias("min"),
    ]
    for name, quartile in zip(("q1", "median", "q3"), quartiles or ()):
        fields.append((quartile if isinstance(quartile, Column) else F.lit(quartile)).cast("double").alias(name))
    return [*fields, plain_zero(F.max(value)).alias("max")]


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum per numeric column."""
    columns = columns or numeric_columns(df)
    return _long_form(df, [F.struct(*_statistics(c, None)) for c in columns])


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, minimum and maximum per text column."""
    columns = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return _long_form(
        df,
        [
            F.struct(
                F.lit(c).alias("column_name"), F.count(c).alias("n"), F.min(c).alias("min"), F.max(c).alias("max")
            )
            for c in columns
        ],
    )


def summary_numeric(df: DataFrame, columns: Sequence[str] | None = None, rel_error: float = 0.0) -> DataFrame:
    """``describe_numeric`` with exact discrete quartiles.

    ``rel_error`` > 0 takes quartiles from a sketch instead, off by at most that share of the ranks: all
    statistics then come from one scan.
    """
    columns = columns or numeric_columns(df)
    probs = (0.25, 0.5, 0.75)
    if rel_error > 0:
        sketched = {c: sketched_quantiles(df, c, probs, rel_error) for c in columns}
        quartiles = {c: [found[i] for i in range(len(probs))] for c, found in sketched.items()}
    else:
        quartiles = exact_quantiles(df, columns, probs)
    return _long_form(df, [F.struct(*_statistics(c, quartiles[c])) for c in columns])


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None, pairs_in_sql: int = 200) -> DataFrame:
    """Pearson correlation of each pair of numeric columns (lower triangle), pairwise complete, in one scan.

    Up to twenty columns are one aggregate of pairs. One of thousands of pairs would not compile, so wider frames take a matrix product.
    """
    columns = columns or numeric_columns(df)
    if len(columns) * (len(columns) - 1) // 2 > pairs_in_sql:
        return wide_correlation(df, columns)

    def correlation(a: str, b: str) -> Column:
        # The built-in one stops the job where a column has no spread.
        spread = F.stddev_pop(F.when(F.col(b).isNotNull(), F.col(a))) * F.stddev_pop(F.when(F.col(a).isNotNull(), F.col(b)))
        return F.round(F.try_divide(F.covar_pop(a, b), spread), DIGITS)

    entries = [
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), correlation(a, b).alias("r"))
        for i, a in enumerate(columns)
        for b in columns[:i]
    ]
    return _long_form(df, entries)


def _gram(shift: np.ndarray, block_rows: int):
    """Per task and column: for every other one, how many rows have both, and over these the sums, squares and products."""

    def multiply(batches):
        size = len(shift)
        n, total, square, product, odd = (np.zeros((size, size)) for _ in range(5))
        for batch in batches:
            for begin in range(0, batch.num_rows, block_rows):
                part = batch.slice(begin, block_rows)
                given = np.column_stack([~c.is_null().to_numpy(zero_copy_only=False) for c in part.columns]).astype(float)
                x = np.column_stack([pc.fill_null(c, 0.0).to_numpy(zero_copy_only=False) for c in part.columns]) - shift
                strange = ~np.isfinite(x)
                x = np.where(strange, 0.0, x) * given
                n += given.T @ given
                total += x.T @ given
                square += (x * x).T @ given
                product += x.T @ x
                marked = strange * given
                odd += marked.T @ given + given.T @ marked
        rows = {"i": np.arange(size), "n": list(n), "total": list(total), "square": list(square), "product": list(product), "odd": list(odd)}
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int32() if k == "i" else pa.list_(pa.float64())) for k, v in rows.items()})

    return multiply


def wide_correlation(df: DataFrame, columns: Sequence[str], block_rows: int = 4096) -> DataFrame:
    """``corr_matrix`` of many columns: each task multiplies blocks of its rows into one Gram matrix, and the matrices add up.

    NULLs are left out pair by pair by products with the matrix of what is present. Values are taken against a first mean, so that large
    means cost no digits. NaN and infinity make a pair's result NaN; a pair without rows, or with a column without spread, is NULL.
    """
    doubles = df.select(*(F.col("`" + c.replace("`", "``") + "`").cast("double").alias(f"c{k}") for k, c in enumerate(columns)))
    first = doubles.limit(1000).agg(*(F.avg(finite(F.col(c))).alias(c) for c in doubles.columns)).first()
    shift = np.array([0.0 if m is None else m for m in first])
    arrays = ("n", "total", "square", "product", "odd")
    parts = doubles.mapInArrow(_gram(shift, block_rows), "i int, " + ", ".join(f"{a} array<double>" for a in arrays))
    cells = parts.select("i", F.posexplode(F.arrays_zip(*arrays)).alias("j", "v")).groupBy("i", "j")
    sums = cells.agg(*(F.sum(f"v.{a}").alias(a) for a in arrays))
    other = sums.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("total").alias("total_b"), F.col("square").alias("square_b"))
    both = sums.where("j < i").join(other, ["i", "j"])
    n, spread = F.col("n"), lambda total, square: F.col("n") * F.col(square) - F.col(total) * F.col(total)
    scale = spread("total", "square") * spread("total_b", "square_b")
    r = F.when(n == 0, None).when(F.col("odd") > 0, F.lit(float("nan"))).when(scale <= 0, None)
    r = r.otherwise((n * F.col("product") - F.col("total") * F.col("total_b")) / F.sqrt(scale))
    names = F.array(*(F.lit(c) for c in columns))
    return both.select(names[F.col("i")].alias("col_a"), names[F.col("j")].alias("col_b"), F.round(r, DIGITS).alias("r"))


def iqr_bounds(df: DataFrame, column: str, k: float = 1.5, rel_error: float = 0.0) -> dict[str, float] | None:
    """Quartiles and the outlier bounds k inter-quartile ranges beyond them; None without values.

    ``rel_error`` > 0 accepts quartiles off by that share of the ranks, for one cheap pass.
    """
    if rel_error > 0:
        found = df.agg(sketched_quantiles(df, column, (0.25, 0.75), rel_error)).first()[0]
    else:
        found = exact_quantiles(df, [column], (0.25, 0.75))[column]
    if not found or found[0] is None:
        return None
    q1, q3 = found
    reach = (Decimal(str(k)) if isinstance(q3, Decimal) else k) * (q3 - q1)
    return {"q1": q1, "q3": q3, "low": q1 - reach, "high": q3 + reach}


def iqr_outliers(df: DataFrame, column: str, k: float = 1.5, rel_error: float = 0.0) -> DataFrame:
    """Rows outside the IQR bounds. The bounds are constants, so the scan can skip row groups."""
    bounds = iqr_bounds(df, column, k, rel_error)
    if bounds is None:
        return df.filter(F.lit(False))
    return df.filter((F.col(column) < bounds["low"]) | (F.col(column) > bounds["high"]))


def with_zscore(df: DataFrame, column: str, name: str = "zscore") -> DataFrame:
    """Adds (value - mean) / sample standard deviation; NULL when all values are equal."""
    stats = df.agg(F.struct(F.avg(column).alias("mean"), F.stddev(column).alias("sd")).alias("s")).scalar()
    return df.withColumn(name, F.try_divide(F.col(column) - stats["mean"], stats["sd"]))


def zscore_outliers(df: DataFrame, column: str, limit: float = 3.0, name: str = "zscore") -> DataFrame:
    """Rows more than ``limit`` standard deviations from the mean, with their z-score."""
    return with_zscore(df, column, name).filter(F.abs(name) > limit)


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins (bin, bin_from, bin_to, n), all listed; the last bin is closed.

    A column of one value v spans v - 0.5 to v + 0.5. NULL, NaN and infinity are in no bin.
    """
    value = finite(F.col(column).cast("double"))
    low, high = F.min(value), F.max(value)
    flat = low == high
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low) / F.lit(float(bins))
    span = df.agg(F.struct(start.alias("start"), width.alias("width")).alias("s")).scalar()
    low, width = span["start"], span["width"]
    place = F.least(F.floor((value - low) / width), F.lit(bins - 1)).cast("bigint")
    counts = df.filter(value.isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return (
        df.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .join(counts, "bin", "left")
        .select(
            "bin",
            (low + F.col("bin") * width).alias("bin_from"),
            (low + (F.col("bin") + 1) * width).alias("bin_to"),
            F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        )
    )


def grid_counts(df: DataFrame, x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """Rows with both values, counted on a grid: a scatter plot whose size does not grow."""
    complete = not_null(df, [x, y])
    return complete.groupBy(
        F.floor(F.col(x) / x_width).alias("x_bin"), F.floor(F.col(y) / y_width).alias("y_bin")
    ).agg(F.count(F.lit(1)).alias("n"))

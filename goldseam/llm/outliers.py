"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates.

Every whole text gets word and line statistics. Documents that fail the base rules are out. The
others form groups by language and source (by language alone where a group has fewer than
``least_group`` of them, and languages with fewer together). Each group's centre and covariance come
from the three quarters of its documents that lie closest together: starting from medians and
median deviations, concentration steps re-estimate both from the documents within the 0.75 quantile of the
squared Mahalanobis distance. A document is rejected if its distance under its group's
final estimate is past the cutoff.

A concentration step is one aggregate over all documents: sums and products per group and step of the
logarithm of the distance, combined in the map tasks, so a hot group costs nothing more. What
remains, at most BINS rows per group, gives the quantile and the new estimate.

Null texts count as empty. Null languages and sources form groups of their own. Repeated rows are
judged alike; a null doc_id is kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldseam.llm.common import lookup, stored
from goldseam.llm.textstats import SHARES, base_statistics, shares

#: Judged statistics, and the spread of each below which differences mean nothing.
FLOORS = {
    "word_length": 0.05, "symbols": 0.04, "upper": 0.05, "punctuation": 0.05,
    "dup_lines": 0.25, "repeats": 0.25, "variety": 0.02,
}
DIMS = len(FLOORS)
FLOOR = np.array(list(FLOORS.values()))
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Distances are binned by logarithm, eight bins to a power of two.
BINS, PER_OCTAVE, LOWEST = 400, 8, -20
HALF = 0.75


def chi_square(z: float, freedom: int = DIMS) -> float:
    """Quantile of the chi-square distribution at the normal score ``z`` (Wilson and Hilferty)."""
    return freedom * (1 - 2 / (9 * freedom) + z * (2 / (9 * freedom)) ** 0.5) ** 3


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base statistics, base_failed, and x: the judged statistics as an array."""
    picked = [SHARES.index(name) for name in FLOORS]

    def measured(batches):
        for batch in batches:
            base, x = [], []
            for text in batch["text"].to_pylist():
                s = base_statistics(text)
                base.append([s[name] for name in BASE])
                values = shares(s)
                x.append([values[i] for i in picked])
            columns = [pa.array(c, pa.int64()) for c in zip(*base)] or [pa.array([], pa.int64())] * len(BASE)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["lang"], batch["source"], *columns, pa.array(x, pa.list_(pa.float64()))],
                ["doc_id", "lang", "source", *BASE, "x"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang string, source string, {', '.join(f'{c} bigint' for c in BASE)}, x array<double>"
    rows = docs.select(
        "doc_id", F.col("text").cast("binary").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")
    ).mapInArrow(measured, schema)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def group_key(*columns: str) -> Column:
    """Text that tells all combinations apart, nulls too."""
    return F.concat_ws(
        "|", *(F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c))) for c in columns)
    )


def grouped(rows: DataFrame, least_group: int) -> DataFrame:
    """Adds ``grp``: language and source, or language where these have too few rows that passed, or all such languages together."""
    passed = rows.where(~F.col("base_failed"))
    spread = F.xxhash64("doc_id")

    def large(key: Column, name: str) -> DataFrame:
        return passed.groupBy(key.alias(name)).agg(F.count("*").alias("n")).where(F.col("n") >= least_group)

    fine, coarse = group_key("lang", "source"), group_key("lang")
    rows = rows.withColumn("fine", fine).withColumn("coarse", F.concat(F.lit("all "), coarse))
    rows = lookup(rows, large(fine, "fine").withColumn("has_fine", F.lit(True)), "fine", "n", spread)
    rows = lookup(rows, large(F.concat(F.lit("all "), coarse), "coarse").withColumn("has_coarse", F.lit(True)), "coarse", "n", spread)
    grp = F.when(F.col("has_fine"), F.col("fine")).when(F.col("has_coarse"), F.col("coarse")).otherwise(F.lit("rest"))
    return rows.withColumn("grp", grp).drop("fine", "coarse", "has_fine", "has_coarse")


def distance() -> Column:
    """Squared Mahalanobis distance of x from ``centre`` under the upper triangle ``precision``, in plain arithmetic."""
    gap = [F.col("x")[j] - F.col("centre")[j] for j in range(DIMS)]
    total, at = F.lit(0.0), 0
    for j in range(DIMS):
        for k in range(j, DIMS):
            total = total + F.col("precision")[at] * (1.0 if j == k else 2.0) * gap[j] * gap[k]
            at += 1
    return F.greatest(total, F.lit(0.0))


def first_estimate(rows: DataFrame) -> DataFrame:
    """Medians, and a diagonal covariance of median deviations."""
    names = range(DIMS)
    medians = rows.groupBy("grp").agg(
        F.count("*").alias("n"), F.array(*(F.percentile_approx(F.col("x")[j], 0.5, 1000) for j in names)).alias("centre")
    )
    gaps = lookup(rows, medians, "grp", "n", F.xxhash64("doc_id"))
    spread = gaps.groupBy("grp").agg(
        F.count("*").alias("n"),
        F.first("centre").alias("centre"),
        *(F.percentile_approx(F.abs(F.col("x")[j] - F.col("centre")[j]), 0.5, 1000).alias(f"s{j}") for j in names),
    )
    inverse = [F.lit(1.0) / (F.pow(F.lit(1.4826) * F.col(f"s{j}"), 2) + F.lit(float(FLOOR[j] ** 2))) for j in names]
    triangle = [inverse[j] if j == k else F.lit(0.0) for j in names for k in range(j, DIMS)]
    return spread.select("grp", "n", "centre", F.array(*triangle).alias("precision"), F.lit(1.0).alias("scale"))


def _estimate(bins: pd.DataFrame) -> pd.DataFrame:
    """One group's next centre, precision and scale from at most BINS rows of sums."""
    bins = bins.sort_values("bin")
    n = bins["n"].to_numpy()
    total = int(n.sum())
    running = n.cumsum()
    keep = running - n < HALF * total  # every bin that begins below the quantile
    count = n[keep].sum()
    sums = np.array([bins[f"s{j}"].to_numpy()[keep].sum() for j in range(DIMS)])
    centre = sums / count
    cov = np.zeros((DIMS, DIMS))
    for j in range(DIMS):
        for k in range(j, DIMS):
            cov[j, k] = cov[k, j] = bins[f"p{j}_{k}"].to_numpy()[keep].sum() / count - centre[j] * centre[k]
    cov = (cov + cov.T) / 2
    values, vectors = np.linalg.eigh(cov)
    cov = (vectors * np.maximum(values, 0)) @ vectors.T + np.diag(FLOOR**2)
    precision = np.linalg.inv(cov)
    middle = 2 ** ((bins["bin"].to_numpy()[np.searchsorted(running, total / 2)] + 0.5) / PER_OCTAVE + LOWEST)
    # A tight core has a small median distance; scaling may at most quadruple distances.
    scale = chi_square(0) / max(middle, chi_square(0) / 4)
    return pd.DataFrame([{
        "grp": bins["grp"].iloc[0], "n": total, "centre": list(centre),
        "precision": [precision[j, k] for j in range(DIMS) for k in range(j, DIMS)], "scale": scale,
    }])


def concentrate(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """One concentration step for all groups. ``scale`` is that of the estimate given, brought to the new one."""
    d = lookup(rows, estimate, "grp", "n", F.xxhash64("doc_id")).withColumn("d2", distance())
    level = F.floor((F.log2(F.col("d2") + 2.0**LOWEST) - LOWEST) * PER_OCTAVE)
    binned = d.withColumn("bin", F.least(level, F.lit(BINS - 1)).cast("int"))
    x = [F.col("x")[j] for j in range(DIMS)]
    sums = binned.groupBy("grp", "bin").agg(
        F.count("*").alias("n"),
        *(F.sum(x[j]).alias(f"s{j}") for j in range(DIMS)),
        *(F.sum(x[j] * x[k]).alias(f"p{j}_{k}") for j in range(DIMS) for k in range(j, DIMS)),
    )
    schema = "grp string, n bigint, centre array<double>, precision array<double>, scale double"
    return sums.groupBy("grp").applyInPandas(_estimate, schema)


def judge(docs: DataFrame, cutoff: float = chi_square(7.0), least_group: int = 100, steps: int = 4) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept, and distance (null where no row passed the base rules).

    Groups of fewer than ``least_group`` rows are estimated with their language, languages of fewer with each other.
    """
    measured = stored(statistics(docs), "outliers-statistics")
    rows = stored(grouped(measured, least_group), "outliers-grouped")
    judged = rows.where(~F.col("base_failed"))
    estimate = stored(first_estimate(judged), "outliers-estimate")
    for _ in range(steps):
        estimate = stored(concentrate(judged, estimate), "outliers-estimate")
    scored = lookup(rows, estimate, "grp", "n", F.xxhash64("doc_id")).withColumn("distance", distance() * F.col("scale"))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cutoff)
    return scored.select("doc_id", *BASE, "base_failed", kept.alias("kept"), "distance")

"""The datasets behind the claim dashboards, all from one table of judged claims.

Column names are those of the judged claims table; see ``goldseam.plans.claims``.
Rows with a missing group key are left out unless a label for them is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldseam.functions.dates import month_label
from goldseam.functions.fixed_point import WIDE, exact_mean, exact_sum, exact_total, percent, rounded, units_of
from goldseam.functions.scores import HIGH, MIDDLE
from goldseam.operators.aggregates import (
    count_by,
    count_where,
    counts_with_categories,
    cross_counts,
    measures_with_categories,
    rows,
    top_groups,
)
from goldseam.operators.profile import histogram
from goldseam.operators.quantiles import exact_quantiles, sketched_quantiles
from goldseam.operators.shaping import not_null

# Report labels, decisions and severities, in report order.
NO_PREDICTION = "Sin predicción"
NO_CONFIDENCE = "sin datos"
NO_DECISION = "SIN DECISIÓN"
DECISIONS = ("LIBERADO", "REVISION_MENOR", "INVESTIGAR")
SEVERITIES = ("Minor Damage", "Major Damage", "Total Loss", "Trivial Damage")
COHERENT, INCOHERENT = "Coherente", "Incoherente"
DAY_PARTS = ("Madrugada", "Mañana", "Tarde", "Noche")  # six hours each, from midnight


def counts_with_label(df: DataFrame, column: str, missing: str) -> DataFrame:
    """Rows per value and their percentage, a missing value counting under its own label."""
    counts = count_by(df.select(F.coalesce(column, F.lit(missing)).alias(column)), [column])
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", percent(F.col("n"), total))


def loss_by(df: DataFrame, key: str, amount: str = "claim_total") -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(exact_sum(amount).alias("total_loss"))


def claims_per_hour(df: DataFrame, hour: str = "incident_hour") -> DataFrame:
    """Rows per hour of the day with the part of the day it belongs to."""
    counts = count_by(df.filter(F.col(hour).isNotNull()).select(F.col(hour).cast("int").alias(hour)), [hour])
    part = F.get(F.array(*(F.lit(p) for p in DAY_PARTS)), F.floor(F.col(hour) / 6).cast("int"))
    return counts.withColumn("day_part", part)


def top_makes(df: DataFrame, make: str = "auto_make", amount: str = "claim_total", k: int = 5) -> DataFrame:
    """The k makes with the largest loss, and their share of the loss of these k."""
    best = top_groups(df, make, exact_total(amount), k, "loss")
    # k rows at most reach this window.
    units = units_of(F.col("loss"))
    pct = percent(units, F.sum(units).over(Window.partitionBy()), kind=WIDE)
    return best.select(make, rounded(F.col("loss")).alias("total_loss"), pct.alias("pct"))


def amount_centre(df: DataFrame, amount: str = "claim_total", rel_error: float = 0.0) -> DataFrame:
    """One row: mean and exact median of the amount; with ``rel_error`` > 0 a median off by at most that share of the ranks, in one scan."""
    if rel_error > 0:
        median = sketched_quantiles(df, amount, [0.5], rel_error)[0]
    else:
        median = F.lit(exact_quantiles(df, [amount], [0.5], continuous=True)[amount][0])
    return df.agg(exact_mean(amount).alias("mean_total"), median.cast("double").alias("median_total"))


def claims_per_month(df: DataFrame, day: str = "claim_date", keep_undated: bool = False) -> DataFrame:
    dated = df if keep_undated else df.filter(F.col(day).isNotNull())
    return count_by(dated.select(month_label(day).alias("month")), ["month"])


def coherence(df: DataFrame, rule: str = "r5_coherencia_severidad") -> DataFrame:
    """Claims whose reported severity fits the predicted damage, and those where it does not."""
    verdict = F.when(F.coalesce(rule, F.lit(True)), COHERENT).otherwise(INCOHERENT)
    counts = count_by(df.select(verdict.alias("coherence")), ["coherence"])
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", percent(F.col("n"), total))


def score_by_label(df: DataFrame, label: str = "damage_label", score: str = "damage_score") -> DataFrame:
    """Mean and sample deviation of the score per label; one single score deviates by 0."""
    spread = F.coalesce(F.stddev(score), F.lit(0.0))
    return (
        df.filter(F.col(label).isNotNull())
        .groupBy(label)
        .agg(rows().alias("n"), exact_mean(score, 4).alias("mean_score"), F.round(spread, 6).alias("std_score"))
    )


def score_points(
    df: DataFrame, label: str = "damage_label", score: str = "damage_score", amount: str = "claim_total"
) -> DataFrame:
    """The points of score against amount per label: one row per complete row, without a shuffle."""
    return not_null(df, [label, score, amount]).select(label, score, amount)


def score_against_amount(
    df: DataFrame,
    label: str = "damage_label",
    score: str = "damage_score",
    amount: str = "claim_total",
    score_bins: int = 20,
    amount_width: float = 5000.0,
) -> DataFrame:
    """Complete rows counted on a grid of score and amount per label."""
    complete = not_null(df, [label, score, amount])
    return count_by(
        complete.select(
            label,
            F.floor(F.col(score) * score_bins).alias("score_bin"),
            F.floor(F.col(amount) / amount_width).alias("amount_bin"),
        ),
        [label, "score_bin", "amount_bin"],
    )


def coverage(df: DataFrame, label: str = "damage_label", level: str = "confidence_level") -> DataFrame:
    """(category, n, pct): with and without prediction, reliable and not reliable.

    Claims without prediction count as not reliable.
    """
    n_rows, predicted = rows(), F.count(label)
    reliable = count_where(F.col(level).isin(HIGH, MIDDLE))
    parts = {
        "with_prediction": predicted,
        "without_prediction": n_rows - predicted,
        "reliable": reliable,
        "not_reliable": n_rows - reliable,
    }
    entries = [
        F.struct(F.lit(name).alias("category"), n.alias("n"), percent(n, n_rows).alias("pct"))
        for name, n in parts.items()
    ]
    return df.agg(F.array(*entries).alias("rows")).select(F.inline("rows"))


def label_by_decision(df: DataFrame, label: str = "damage_label", decision: str = "decision_final") -> DataFrame:
    return cross_counts(df.filter(F.col(label).isNotNull()), label, decision, DECISIONS)


def rule_failures(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(reason, n) for {rule column: reason}; a NULL verdict is no failure."""
    entries = [
        F.struct(F.lit(reason).alias("reason"), count_where(~F.col(rule)).alias("n"))
        for rule, reason in rules.items()
    ]
    return df.agg(F.array(*entries).alias("rows")).select(F.inline("rows"))


def failures_by_severity(
    df: DataFrame, severity: str = "incident_severity", failed: str = "reglas_fallidas"
) -> DataFrame:
    known = df.filter(F.col(severity).isNotNull())
    return known.groupBy(severity).agg(exact_mean(failed, 4).alias("mean_failed"))


def executive_kpis(df: DataFrame) -> DataFrame:
    """One row: claims, decisions with percentages, predicted claims, mean score, amounts."""
    n_rows, predicted = rows(), F.count("damage_label")
    released, review, investigate = (count_where(F.col("decision_final") == d) for d in DECISIONS)
    at_risk = F.when(F.col("decision_final") == DECISIONS[-1], F.col("claim_total"))
    return df.agg(
        n_rows.alias("total_claims"),
        released.alias("released"),
        percent(released, n_rows).alias("released_pct"),
        review.alias("minor_review"),
        percent(review, n_rows).alias("minor_review_pct"),
        investigate.alias("to_investigate"),
        percent(investigate, n_rows).alias("to_investigate_pct"),
        predicted.alias("predicted"),
        percent(predicted, n_rows).alias("predicted_pct"),
        exact_mean("damage_score", 4).alias("mean_score"),
        exact_sum("claim_total").alias("total_amount"),
        exact_sum(at_risk).alias("amount_at_risk"),
    )


def dashboards(judged: DataFrame, rules: dict[str, str]) -> dict[str, DataFrame]:
    """All datasets of the business, prediction and decision views, by name.

    ``judged`` is best the stored table: each dataset then scans the few columns it needs.
    """
    return {
        "claims_by_severity": counts_with_categories(judged, "incident_severity", SEVERITIES),
        "loss_by_incident_type": loss_by(judged, "incident_type"),
        "claims_per_hour": claims_per_hour(judged),
        "top_makes": top_makes(judged),
        "amount_histogram": histogram(judged, "claim_total"),
        "amount_centre": amount_centre(judged),
        "claims_per_month": claims_per_month(judged),
        "predictions_by_label": counts_with_label(judged, "damage_label", NO_PREDICTION),
        "predictions_by_confidence": counts_with_label(judged, "confidence_level", NO_CONFIDENCE),
        "coherence": coherence(judged),
        "score_by_label": score_by_label(judged),
        "score_against_amount": score_against_amount(judged),
        "score_points": score_points(judged),
        "coverage": coverage(judged),
        "decisions": counts_with_label(judged, "decision_final", NO_DECISION),
        "label_by_decision": label_by_decision(judged),
        "rule_failures": rule_failures(judged, rules),
        "amount_by_decision": measures_with_categories(judged, "decision_final", DECISIONS, F.col("claim_total")),
        "failures_by_severity": failures_by_severity(judged),
        "executive_kpis": executive_kpis(judged),
    }

"""The dashboard datasets, from the judged claims of ``goldseam.plans.bound.claims``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldseam.operators import insights
from goldseam.operators.aggregates import count_by, counts_with_categories, measures_with_categories
from goldseam.operators.joins import enrich
from goldseam.operators.profile import histogram
from goldseam.plans import claims
from goldseam.plans.bound.claims import JUDGED_SQL, judged, raw_claims
from goldseam.plans.bound.registry import Tables, query, sql_mean, sql_pct, sql_sum


def reported(t: Tables) -> DataFrame:
    """Claims under their report names; datasets on claim columns alone need no join."""
    return raw_claims(t).select(*(F.col(c).alias(name) for name, c in claims.CLAIM_COLUMNS.items()))


@query(JUDGED_SQL + "SELECT decision_final, count(*) AS n FROM judged GROUP BY 1")
def decision_distribution(t: Tables) -> DataFrame:
    return count_by(judged(t), ["decision_final"])


@query(
    JUDGED_SQL
    + f""", c AS (SELECT coalesce(decision_final, 'SIN DECISIÓN') AS decision_final, count(*) AS n FROM judged GROUP BY 1)
    SELECT decision_final, n, {sql_pct("n", "(SELECT sum(n) FROM c)")} AS pct FROM c"""
)
def bi_decisions(t: Tables) -> DataFrame:
    return insights.counts_with_label(judged(t), "decision_final", insights.NO_DECISION)


@query(
    JUDGED_SQL
    + """SELECT place, s.incident_severity, count(j.claim_total) AS n
    FROM (VALUES (0, 'Minor Damage'), (1, 'Major Damage'), (2, 'Total Loss'), (3, 'Trivial Damage'))
        AS s(place, incident_severity) LEFT JOIN judged j ON s.incident_severity = j.incident_severity GROUP BY ALL"""
)
def bi_reindex(t: Tables) -> DataFrame:
    return counts_with_categories(reported(t), "incident_severity", insights.SEVERITIES)


@query(JUDGED_SQL + f"SELECT incident_type, {sql_sum('claim_total')} AS total_loss FROM judged GROUP BY 1")
def bi_loss_by_type(t: Tables) -> DataFrame:
    return insights.loss_by(reported(t), "incident_type")


@query(
    JUDGED_SQL
    + """SELECT incident_hour, count(*) AS n, CASE WHEN incident_hour < 6 THEN 'Madrugada'
        WHEN incident_hour < 12 THEN 'Mañana' WHEN incident_hour < 18 THEN 'Tarde' ELSE 'Noche' END AS day_part
    FROM judged WHERE incident_hour IS NOT NULL GROUP BY ALL"""
)
def bi_hourly(t: Tables) -> DataFrame:
    return insights.claims_per_hour(reported(t))


@query(
    """
    SELECT CAST(hour(ts) AS INTEGER) AS event_hour, count(*) AS n, CASE WHEN hour(ts) < 6 THEN 'Madrugada'
        WHEN hour(ts) < 12 THEN 'Mañana' WHEN hour(ts) < 18 THEN 'Tarde' ELSE 'Noche' END AS day_part
    FROM events GROUP BY ALL
    """
)
def events_per_hour(t: Tables) -> DataFrame:
    return insights.claims_per_hour(t.events.select(F.hour("ts").alias("event_hour")), "event_hour")


@query(
    f"""
    WITH b AS (SELECT p_brand AS auto_make, {sql_sum("l_extendedprice")} AS total_loss
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE p_brand IS NOT NULL GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 5)
    SELECT auto_make, total_loss, {sql_pct("CAST(round(total_loss * 100) AS BIGINT)",
        "(SELECT sum(CAST(round(total_loss * 100) AS BIGINT)) FROM b)")} AS pct FROM b
    """
)
def bi_top_makes(t: Tables) -> DataFrame:
    sold = t.lineitem.select("l_partkey", F.col("l_extendedprice").alias("claim_total"))
    return insights.top_makes(enrich(sold, t.part, {"l_partkey": "p_partkey"}, {"auto_make": "p_brand"}))


@query(
    """
    WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
            (max(l_extendedprice) - min(l_extendedprice)) / 20.0 AS w FROM lineitem),
    c AS (SELECT CAST(least(floor((l_extendedprice - lo) / w), 19) AS BIGINT) AS bin, count(*) AS n
        FROM lineitem, s GROUP BY 1)
    SELECT b.bin, lo + b.bin * w AS bin_from, lo + (b.bin + 1) * w AS bin_to, coalesce(n, 0) AS n
    FROM (SELECT unnest(range(20)) AS bin) b CROSS JOIN s LEFT JOIN c ON b.bin = c.bin
    """
)
def bi_histogram(t: Tables) -> DataFrame:
    return histogram(reported(t), "claim_total")


@query(
    f"""
    SELECT {sql_mean("l_extendedprice")} AS mean_total, quantile_cont(l_extendedprice, 0.5) AS median_total FROM lineitem
    """
)
def bi_mean_median(t: Tables) -> DataFrame:
    return insights.amount_centre(reported(t))


@query(JUDGED_SQL + "SELECT strftime(claim_date, '%Y-%m') AS month, count(*) AS n FROM judged GROUP BY 1")
def bi_monthly_claims(t: Tables) -> DataFrame:
    return insights.claims_per_month(reported(t))


@query(
    JUDGED_SQL
    + f""", c AS (SELECT coalesce(damage_label, 'Sin predicción') AS damage_label, count(*) AS n FROM judged GROUP BY 1)
    SELECT damage_label, n, {sql_pct("n", "(SELECT sum(n) FROM c)")} AS pct FROM c"""
)
def bi_prediction_labels(t: Tables) -> DataFrame:
    return insights.counts_with_label(judged(t), "damage_label", insights.NO_PREDICTION)


@query(
    JUDGED_SQL
    + f""", c AS (SELECT coalesce(confidence_level, 'sin datos') AS confidence_level, count(*) AS n FROM judged
        GROUP BY 1)
    SELECT confidence_level, n, {sql_pct("n", "(SELECT sum(n) FROM c)")} AS pct FROM c"""
)
def bi_confidence(t: Tables) -> DataFrame:
    return insights.counts_with_label(judged(t), "confidence_level", insights.NO_CONFIDENCE)


@query(
    JUDGED_SQL
    + f""", c AS (SELECT CASE WHEN r5_coherencia_severidad THEN 'Coherente' ELSE 'Incoherente' END AS coherence,
        count(*) AS n FROM judged GROUP BY 1)
    SELECT coherence, n, {sql_pct("n", "(SELECT sum(n) FROM c)")} AS pct FROM c"""
)
def bi_coherence(t: Tables) -> DataFrame:
    return insights.coherence(judged(t))


@query(
    JUDGED_SQL
    + f"""SELECT damage_label, count(*) AS n, {sql_mean("damage_score", 4)} AS mean_score,
        round(coalesce(stddev_samp(damage_score), 0), 6) AS std_score
    FROM judged WHERE damage_label IS NOT NULL GROUP BY 1"""
)
def bi_score_by_label(t: Tables) -> DataFrame:
    return insights.score_by_label(judged(t))


@query(
    JUDGED_SQL
    + """SELECT damage_label, CAST(floor(damage_score * 20) AS BIGINT) AS score_bin,
        CAST(floor(claim_total / 5000.0) AS BIGINT) AS amount_bin, count(*) AS n
    FROM judged WHERE damage_label IS NOT NULL AND damage_score IS NOT NULL AND claim_total IS NOT NULL GROUP BY ALL"""
)
def bi_score_amount(t: Tables) -> DataFrame:
    return insights.score_against_amount(judged(t))


@query(
    JUDGED_SQL
    + """SELECT damage_label, damage_score, claim_total FROM judged
    WHERE damage_label IS NOT NULL AND damage_score IS NOT NULL AND claim_total IS NOT NULL"""
)
def bi_score_points(t: Tables) -> DataFrame:
    return insights.score_points(judged(t))


@query(
    JUDGED_SQL
    + f""", k AS (SELECT count(*) AS total, count(damage_label) AS predicted,
        count(*) FILTER (WHERE confidence_level IN ('alta', 'media')) AS reliable FROM judged)
    SELECT 'with_prediction' AS category, predicted AS n, {sql_pct("predicted", "total")} AS pct FROM k UNION ALL
    SELECT 'without_prediction', total - predicted, {sql_pct("total - predicted", "total")} FROM k UNION ALL
    SELECT 'reliable', reliable, {sql_pct("reliable", "total")} FROM k UNION ALL
    SELECT 'not_reliable', total - reliable, {sql_pct("total - reliable", "total")} FROM k"""
)
def bi_coverage(t: Tables) -> DataFrame:
    return insights.coverage(judged(t))


@query(
    JUDGED_SQL
    + """SELECT damage_label, count(*) FILTER (WHERE decision_final = 'LIBERADO') AS "LIBERADO",
        count(*) FILTER (WHERE decision_final = 'REVISION_MENOR') AS "REVISION_MENOR",
        count(*) FILTER (WHERE decision_final = 'INVESTIGAR') AS "INVESTIGAR"
    FROM judged WHERE damage_label IS NOT NULL GROUP BY 1"""
)
def bi_label_decision(t: Tables) -> DataFrame:
    return insights.label_by_decision(judged(t))


@query(
    JUDGED_SQL
    + " UNION ALL ".join(
        f"SELECT '{reason}' AS reason, count(*) FILTER (WHERE NOT {rule}) AS n FROM judged"
        for rule, reason in claims.REASONS.items()
    )
)
def bi_rule_failures(t: Tables) -> DataFrame:
    return insights.rule_failures(judged(t), claims.REASONS)


@query(
    JUDGED_SQL
    + f"""SELECT place, d.decision_final, {sql_mean("claim_total")} AS mean_value, {sql_sum("claim_total")} AS total_value
    FROM (VALUES (0, 'LIBERADO'), (1, 'REVISION_MENOR'), (2, 'INVESTIGAR')) AS d(place, decision_final)
        LEFT JOIN judged j ON d.decision_final = j.decision_final GROUP BY ALL"""
)
def bi_amount_by_decision(t: Tables) -> DataFrame:
    return measures_with_categories(judged(t), "decision_final", insights.DECISIONS, F.col("claim_total"))


@query(
    JUDGED_SQL
    + f"""SELECT incident_severity, {sql_mean("reglas_fallidas", 4)} AS mean_failed FROM judged
    WHERE incident_severity IS NOT NULL GROUP BY 1"""
)
def bi_failures_by_severity(t: Tables) -> DataFrame:
    return insights.failures_by_severity(judged(t))


def _sql_decided(decision: str) -> str:
    return f"count(*) FILTER (WHERE decision_final = '{decision}')"


@query(
    JUDGED_SQL
    + f"""SELECT count(*) AS total_claims, {_sql_decided("LIBERADO")} AS released,
        {sql_pct(_sql_decided("LIBERADO"), "count(*)")} AS released_pct, {_sql_decided("REVISION_MENOR")} AS minor_review,
        {sql_pct(_sql_decided("REVISION_MENOR"), "count(*)")} AS minor_review_pct,
        {_sql_decided("INVESTIGAR")} AS to_investigate,
        {sql_pct(_sql_decided("INVESTIGAR"), "count(*)")} AS to_investigate_pct, count(damage_label) AS predicted,
        {sql_pct("count(damage_label)", "count(*)")} AS predicted_pct, {sql_mean("damage_score", 4)} AS mean_score,
        {sql_sum("claim_total")} AS total_amount,
        {sql_sum("CASE WHEN decision_final = 'INVESTIGAR' THEN claim_total END")} AS amount_at_risk
    FROM judged"""
)
def bi_executive_kpis(t: Tables) -> DataFrame:
    return insights.executive_kpis(judged(t))

"""Claim integration and rules, on test tables brought into the shape of the claim tables.

Order lines stand for claims, orders for policies, events for image predictions of the
claim whose number is the user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldseam.functions.scores import confidence_tier
from goldseam.functions.text import name_part
from goldseam.operators.aggregates import kpi, mean, rows
from goldseam.operators.joins import hot_keys
from goldseam.operators.scoring import enrich_predictions
from goldseam.plans import claims
from goldseam.plans.bound.registry import Tables, query, sql_mean
from goldseam.session import scratch_path
from goldseam.sources.sinks import can_bucket, write_layer

# Event kind -> label; an error has no label.
DAMAGE = {"click": "scratch", "view": "dent", "signup": "crack", "purchase": "glass"}
# Line number -> reported severity; the others are not reported.
SEVERITY = {1: "Trivial Damage", 2: "Minor Damage", 3: "Minor Damage", 4: "Major Damage", 5: "Major Damage", 6: "Total Loss"}


def _mapped(column: str, mapping: dict):
    result = F.lit(None).cast("string")
    for key, value in mapping.items():
        result = F.when(F.col(column) == key, value).otherwise(result)
    return result


def _sql_mapped(column: str, mapping: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {k!r} THEN '{v}'" for k, v in mapping.items()) + " END"


def raw_claims(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_partkey").alias("claim_no"),
        F.col("l_orderkey").alias("policy_no"),
        F.col("l_shipdate").cast("date").alias("claim_date"),
        F.col("l_extendedprice").alias("total"),
        F.col("l_linenumber").alias("age"),
        F.col("l_returnflag").alias("type"),
        F.col("l_linestatus").alias("collision_type"),
        _mapped("l_linenumber", SEVERITY).alias("severity"),
        (F.col("l_quantity").cast("int") % 24).alias("hour"),
        F.col("l_linenumber").alias("number_of_vehicles_involved"),
        F.col("l_tax").alias("injury"),
        F.col("l_discount").alias("number_of_witnesses"),
    )


def raw_policies(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        F.col("o_orderkey").alias("POLICY_NO"),
        F.col("o_custkey").alias("CUST_ID"),
        F.col("o_custkey").alias("CHASSIS_NO"),
        (F.col("o_totalprice") / 10).alias("PREMIUM"),
        day.alias("POL_EFF_DATE"),
        F.date_add(day, 60).alias("POL_EXPIRY_DATE"),
        F.col("o_orderpriority").alias("MAKE"),
        F.col("o_orderstatus").alias("MODEL"),
        F.year(day).alias("MODEL_YEAR"),
    )


def raw_customers(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        name_part("c_name", 0, "#").alias("last_name"),
        name_part("c_name", 1, "#").alias("first_name"),
        F.date_add(F.lit("1960-01-01").cast("date"), F.col("c_nationkey") * 365).alias("date_of_birth"),
        F.col("c_mktsegment").alias("address"),
    )


def predictions(t: Tables) -> DataFrame:
    """Scored images with their claim and vehicle."""
    score = F.least(F.col("value") / 100, F.lit(1.0))
    return t.events.select(
        F.col("event_id").cast("string").alias("image_name"),
        F.col("user_id").alias("claim_no"),
        F.col("user_id").alias("chassis_no"),
        _mapped("event_type", DAMAGE).alias("damage_label"),
        score.alias("damage_score"),
        confidence_tier(score).alias("confidence_level"),
        (score >= 0.5).alias("is_reliable"),
        F.col("ts").alias("predicted_at"),
    )


def judged(t: Tables, people: bool = False) -> DataFrame:
    best = claims.best_prediction(predictions(t))
    customers = raw_customers(t) if people else None
    facts = raw_claims(t)
    base = claims.claim_base(facts, raw_policies(t), customers, best, hot_keys(facts, "claim_no"))
    return claims.judged_claims(base)


PREDICTIONS_SQL = f"""
    SELECT CAST(event_id AS VARCHAR) AS image_name, user_id AS claim_no, user_id AS chassis_no,
        {_sql_mapped("event_type", DAMAGE)} AS damage_label, least(value / 100, 1.0) AS damage_score,
        CASE WHEN least(value / 100, 1.0) >= 0.8 THEN 'alta' WHEN least(value / 100, 1.0) >= 0.5 THEN 'media'
            ELSE 'baja' END AS confidence_level,
        least(value / 100, 1.0) >= 0.5 AS is_reliable, ts AS predicted_at
    FROM events
"""
BEST_SQL = """
    SELECT claim_no, arg_max(damage_label, row(damage_score, image_name)) FILTER (WHERE damage_label IS NOT NULL)
            AS damage_label,
        round(max(damage_score) FILTER (WHERE damage_label IS NOT NULL), 4) AS damage_score,
        arg_max_null(confidence_level, row(damage_score, image_name)) FILTER (WHERE damage_label IS NOT NULL) AS confidence_level,
        CAST(sum(CAST(is_reliable AS INTEGER)) AS BIGINT) AS imagenes_confiables, count(*) AS total_imagenes
    FROM predictions GROUP BY claim_no
"""
# The judged claims as a chain of common table expressions, to be followed by a SELECT from "judged".
JUDGED_SQL = f"""
    WITH predictions AS ({PREDICTIONS_SQL}), best AS ({BEST_SQL}),
    base AS (
        SELECT l.l_partkey AS claim_no, l_orderkey AS policy_no, CAST(l_shipdate AS DATE) AS claim_date,
            CAST(l_shipdate AS DATE) AS incident_date, l_extendedprice AS claim_total, l_returnflag AS incident_type,
            l_linestatus AS collision_type, {_sql_mapped("l_linenumber", SEVERITY)} AS incident_severity,
            CAST(NULL AS VARCHAR) AS authorities_contacted, CAST(l_quantity AS INTEGER) % 24 AS incident_hour,
            l_linenumber AS number_of_vehicles_involved, l_tax AS bodily_injuries, l_discount AS witnesses,
            CAST(NULL AS VARCHAR) AS police_report_available, o_orderpriority AS auto_make,
            o_orderstatus AS auto_model, CAST(year(o_orderdate) AS INTEGER) AS auto_year, o_custkey AS chassis_no,
            o_totalprice / 10 AS premium, CAST(o_orderdate AS DATE) AS policy_start,
            CAST(o_orderdate AS DATE) + 60 AS policy_end, split_part(c_name, '#', 2) AS first_name,
            split_part(c_name, '#', 1) AS last_name, DATE '1960-01-01' + c_nationkey * 365 AS date_of_birth,
            damage_label, damage_score, confidence_level, imagenes_confiables, total_imagenes
        FROM lineitem l LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
            LEFT JOIN best ON l.l_partkey = best.claim_no),
    rules AS (
        SELECT *, coalesce(incident_date >= policy_start AND incident_date <= policy_end, true) AS r1_poliza_vigente,
            coalesce(claim_total <= premium * 3, true) AS r2_monto_razonable, true AS r3_reporte_policial,
            coalesce(confidence_level IN ('alta', 'media'), true) AS r4_prediccion_confiable,
            coalesce(NOT (damage_label IN ('scratch', 'dent') AND incident_severity IN ('Major Damage', 'Total Loss')),
                true) AS r5_coherencia_severidad, true AS r6_tiempo_razonable
        FROM base),
    counted AS (
        SELECT *, CAST(NOT r1_poliza_vigente AS INTEGER) + CAST(NOT r2_monto_razonable AS INTEGER)
            + CAST(NOT r4_prediccion_confiable AS INTEGER) + CAST(NOT r5_coherencia_severidad AS INTEGER)
            AS reglas_fallidas
        FROM rules),
    judged AS (
        SELECT *, CASE reglas_fallidas WHEN 0 THEN 'LIBERADO' WHEN 1 THEN 'REVISION_MENOR' ELSE 'INVESTIGAR' END
                AS decision_final,
            concat_ws(' | ', CASE WHEN NOT r1_poliza_vigente THEN 'Póliza no vigente' END,
                CASE WHEN NOT r2_monto_razonable THEN 'Monto excesivo' END,
                CASE WHEN NOT r4_prediccion_confiable THEN 'Predicción no confiable' END,
                CASE WHEN NOT r5_coherencia_severidad THEN 'Severidad incoherente' END) AS motivos_revision
        FROM counted)
"""


@query(JUDGED_SQL + "SELECT * FROM judged")
def claim_rules(t: Tables) -> DataFrame:
    return judged(t, people=True)


@query(f"WITH predictions AS ({PREDICTIONS_SQL}) {BEST_SQL}")
def best_prediction(t: Tables) -> DataFrame:
    return claims.best_prediction(predictions(t))


@query(
    f"""
    WITH predictions AS ({PREDICTIONS_SQL})
    SELECT claim_no, arg_max(damage_label, row(damage_score, image_name)) FILTER (WHERE damage_label IS NOT NULL)
            AS damage_label, count(image_name) AS num_imagenes, round(max(damage_score) FILTER (WHERE damage_label IS NOT NULL), 4) AS max_score,
        {sql_mean("damage_score", 4)} AS avg_score,
        string_agg(DISTINCT confidence_level, ',' ORDER BY confidence_level) AS niveles_confianza
    FROM predictions GROUP BY claim_no
    """
)
def dominant_damage(t: Tables) -> DataFrame:
    return claims.dominant_damage(predictions(t))


@query(
    f"""
    WITH predictions AS ({PREDICTIONS_SQL})
    SELECT CAST(claim_no AS VARCHAR) AS claim_no, CAST(chassis_no AS VARCHAR) AS chassis_no, image_name, damage_label,
        round(damage_score, 4) AS damage_score, confidence_level, is_reliable, predicted_at,
        'damage@champion' AS pipeline_version FROM predictions
    """
)
def curated_predictions(t: Tables) -> DataFrame:
    curated = claims.curate_predictions(predictions(t), "damage@champion")
    return curated.withColumn("predicted_at", F.col("predicted_at").cast("timestamp_ntz"))


@query(
    f"""
    WITH predictions AS ({PREDICTIONS_SQL})
    SELECT count(*) AS total_registros, count(DISTINCT claim_no) AS claims_cubiertos,
        count(DISTINCT chassis_no) AS chassis_distintos, count(DISTINCT image_name) AS imagenes_procesadas,
        CAST(sum(CAST(is_reliable AS INTEGER)) AS BIGINT) AS predicciones_confiables,
        {sql_mean("damage_score", 4)} AS score_promedio, round(min(damage_score), 4) AS score_minimo,
        round(max(damage_score), 4) AS score_maximo, min(predicted_at) AS primera_prediccion,
        max(predicted_at) AS ultima_prediccion
    FROM predictions
    """
)
def prediction_statistics(t: Tables) -> DataFrame:
    return claims.prediction_statistics(predictions(t))


@query(
    """
    SELECT e.vec_id, e.label, p_name, p_brand, p_type, p_size, p_retailprice
    FROM embeddings e LEFT JOIN part ON e.vec_id = p_partkey
    """
)
def predictions_enriched(t: Tables) -> DataFrame:
    metadata = t.part.withColumnRenamed("p_partkey", "vec_id")
    return enrich_predictions(t.embeddings.select("vec_id", "label"), metadata, "vec_id")


CLAIM_POLICY_SQL = """
    SELECT l_partkey AS claim_no, l_orderkey AS policy_no, CAST(l_shipdate AS DATE) AS claim_date,
        l_extendedprice AS claim_total, l_linenumber AS age, o_custkey AS chassis_no, o_totalprice / 10 AS premium,
        CAST(o_orderdate AS DATE) AS policy_start_date, CAST(o_orderdate AS DATE) + 60 AS policy_end_date,
        o_custkey AS cust_id, split_part(c_name, '#', 2) AS first_name, split_part(c_name, '#', 1) AS last_name,
        DATE '1960-01-01' + c_nationkey * 365 AS date_of_birth, c_mktsegment AS address
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
"""
TELEMATICS_SQL = f"""
    SELECT user_id AS chassis_no, {sql_mean("value")} AS avg_speed, max(value) AS max_speed, min(value) AS min_speed,
        count(*) AS total_events FROM events GROUP BY user_id
"""


@query(CLAIM_POLICY_SQL)
def claim_policy_customer(t: Tables) -> DataFrame:
    return claims.customer_claim_policy(raw_claims(t), raw_policies(t), raw_customers(t))


def stored_for_policies(t: Tables, buckets: int = 16) -> tuple[DataFrame, DataFrame]:
    """Claims and policies stored once in buckets by policy number, for all joins of them."""
    sides = {"claims_clean": raw_claims(t), "policies_clean": raw_policies(t)}
    bucketed = can_bucket([(sides[n], key) for n, key in claims.POLICY_KEYS.items()], buckets)
    tables = []
    for name, key in claims.POLICY_KEYS.items():
        path = scratch_path(t.spark, name)
        table = path.rsplit("/", 1)[1].replace("-", "_")
        write_layer(sides[name], table, verify=True, bucket_by=(key, buckets) if bucketed else None, path=path)
        tables.append(t.spark.table(table))
    return tuple(tables)


@query(CLAIM_POLICY_SQL)
def claim_policy_bucketed(t: Tables) -> DataFrame:
    return claims.customer_claim_policy(*stored_for_policies(t), raw_customers(t))


@query(JUDGED_SQL + "SELECT decision_final, auto_make, count(*) AS n_claims FROM judged GROUP BY decision_final, auto_make")
def decisions_bucketed(t: Tables) -> DataFrame:
    stored_claims, policies = stored_for_policies(t)
    best = claims.best_prediction(predictions(t))
    judged_rows = claims.judged_claims(claims.claim_base(stored_claims, policies, None, best, hot_keys(stored_claims, "claim_no")))
    return kpi(judged_rows, ["decision_final", "auto_make"], {"n_claims": rows()})


def _enriched(t: Tables) -> DataFrame:
    telematics = kpi(
        t.events.withColumnRenamed("user_id", "chassis_no"),
        ["chassis_no"],
        {
            "avg_speed": mean("value", 2, exact=True),
            "max_speed": F.max("value"),
            "min_speed": F.min("value"),
            "total_events": rows(),
        },
    )
    policies = raw_policies(t)
    return claims.customer_claim_policy(
        raw_claims(t), policies, raw_customers(t), telematics, hot_keys(policies, "CHASSIS_NO")
    )


@query(
    f"""
    WITH c AS ({CLAIM_POLICY_SQL}), m AS ({TELEMATICS_SQL})
    SELECT c.*, avg_speed, max_speed, min_speed, total_events FROM c LEFT JOIN m ON c.chassis_no = m.chassis_no
    """
)
def claims_enriched(t: Tables) -> DataFrame:
    return _enriched(t)


@query(
    f"""
    WITH c AS ({CLAIM_POLICY_SQL}), m AS ({TELEMATICS_SQL}),
    g AS (SELECT c.*, avg_speed FROM c LEFT JOIN m ON c.chassis_no = m.chassis_no)
    SELECT 'no_policy' AS check_name, count(*) FILTER (WHERE policy_no IS NULL) AS n FROM g UNION ALL
    SELECT 'no_customer', count(*) FILTER (WHERE cust_id IS NULL) FROM g UNION ALL
    SELECT 'no_telematics', count(*) FILTER (WHERE avg_speed IS NULL) FROM g UNION ALL
    SELECT 'gold_rows', count(*) FROM g UNION ALL
    SELECT 'source_rows', count(*) FROM lineitem
    """
)
def referential_checks(t: Tables) -> DataFrame:
    return claims.referential_checks(_enriched(t), raw_claims(t))

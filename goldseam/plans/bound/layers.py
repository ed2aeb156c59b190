"""Cleaning steps of the silver layer, on test tables brought into the shape of raw sources."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldseam.functions.dates import BIRTH_DATE_FORMATS, parse_dates
from goldseam.functions.text import file_extension, leading_token, name_part, path_leaf
from goldseam.operators.aggregates import count_by
from goldseam.operators.rejects import MALFORMED, Checks, judge, present, quarantine, rejection_report, within
from goldseam.operators.shaping import dedupe, not_blank
from goldseam.plans import airline, claims
from goldseam.plans.bound.registry import Tables, query
from goldseam.session import scratch_path
from goldseam.sources.readers import CORRUPT, read_csv_kept

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
SQL_FORMATS = ("%m/%d/%Y", "%d/%m/%Y", "%Y-%m-%d", "%d-%m-%Y", "%Y/%m/%d")


def _mixed_dates(day, chooser: str, choices) -> F.Column:
    """A date as text, in the format that goes with the chooser's value; "unknown" otherwise."""
    text = F.lit("unknown")
    for choice, fmt in zip(choices, BIRTH_DATE_FORMATS):
        text = F.when(F.col(chooser) == choice, F.date_format(day, fmt)).otherwise(text)
    return text


def _sql_mixed(day: str, chooser: str, choices) -> str:
    cases = " ".join(f"WHEN '{c}' THEN strftime({day}, '{f}')" for c, f in zip(choices, SQL_FORMATS))
    return f"CASE {chooser} {cases} ELSE 'unknown' END"


def _sql_parse(text: str) -> str:
    return "CAST(coalesce(" + ", ".join(f"try_strptime({text}, '{f}')" for f in SQL_FORMATS) + ") AS DATE)"


@query(
    f"""
    SELECT o_orderkey, day_text, {_sql_parse("day_text")} AS day
    FROM (SELECT o_orderkey, {_sql_mixed("o_orderdate", "o_orderpriority", PRIORITIES[:4])} AS day_text FROM orders)
    """
)
def parse_mixed_dates(t: Tables) -> DataFrame:
    """Order dates written in four formats, and as junk, read back."""
    text = _mixed_dates(F.col("o_orderdate"), "o_orderpriority", PRIORITIES[:4])
    return t.orders.select("o_orderkey", text.alias("day_text")).withColumn("day", parse_dates("day_text"))


@query(
    """
    SELECT c_custkey, split_part(trim(c_name), '#', 1) AS family, nullif(split_part(trim(c_name), '#', 2), '') AS given
    FROM customer
    """
)
def split_name(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", name_part("c_name", 0, "#").alias("family"), name_part("c_name", 1, "#").alias("given")
    )


@query(
    """
    SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', -1) AS leaf,
           split_part(split_part(url, '/', -1), '?', 1) AS token
    FROM pages
    """
)
def url_segments(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id",
        name_part("url", 2, "/").alias("host"),
        path_leaf("url").alias("leaf"),
        leading_token(path_leaf("url"), "?").alias("token"),
    )


@query(
    r"""
    SELECT lower(regexp_extract(split_part(url, '/', 3), '\.(\w+)$', 1)) AS extension, count(*) AS n
    FROM pages GROUP BY 1
    """
)
def url_extension(t: Tables) -> DataFrame:
    return count_by(t.pages.select(file_extension(name_part("url", 2, "/")).alias("extension")), ["extension"])


@query(
    """
    SELECT page_id, url AS path, split_part(url, '/', -1) AS image_name,
           split_part(split_part(url, '/', -1), '_', 1) AS label
    FROM pages WHERE url IS NOT NULL AND split_part(split_part(url, '/', -1), '_', 1) <> ''
    """
)
def silver_pages(t: Tables) -> DataFrame:
    return claims.silver_training_images(t.pages.select("page_id", F.col("url").alias("path")))


@query(
    """
    SELECT doc_id, lang, source, length(trim(text)) AS trimmed_chars FROM documents
    WHERE text IS NOT NULL AND trim(text) <> '' AND trim(lang) <> ''
    """
)
def silver_documents(t: Tables) -> DataFrame:
    return not_blank(t.documents, ["text", "lang"]).select(
        "doc_id", "lang", "source", F.length(F.trim("text")).cast("bigint").alias("trimmed_chars")
    )


@query(
    """
    SELECT * EXCLUDE place FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
            l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
            l_linestatus DESC) AS place FROM lineitem)
    WHERE place = 1
    """
)
def dedupe_lineitem(t: Tables) -> DataFrame:
    return dedupe(t.lineitem, ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate")])


@query(
    """
    SELECT * EXCLUDE place FROM (
        SELECT *, row_number() OVER (PARTITION BY vuelo_id ORDER BY fecha DESC, origen_id DESC, destino_id DESC,
            aeronave_id DESC, estado DESC, duracion_min DESC) AS place
        FROM (SELECT CAST(l_orderkey AS VARCHAR) AS vuelo_id, CAST(l_shipdate AS DATE) AS fecha,
            CAST(l_suppkey AS VARCHAR) AS origen_id, CAST(l_linenumber AS VARCHAR) AS destino_id,
            CAST(l_partkey AS VARCHAR) AS aeronave_id, l_linestatus AS estado,
            CAST(l_quantity AS INTEGER) AS duracion_min FROM lineitem))
    WHERE place = 1
    """
)
def silver_orders(t: Tables) -> DataFrame:
    """Order lines as raw flights: one row per order is kept."""
    raw = t.lineitem.select(
        F.col("l_orderkey").alias("vuelo_id"),
        F.col("l_shipdate").cast("string").alias("fecha"),
        F.col("l_suppkey").alias("origen_id"),
        F.col("l_linenumber").alias("destino_id"),
        F.col("l_partkey").alias("aeronave_id"),
        F.col("l_linestatus").alias("estado"),
        F.col("l_quantity").cast("int").cast("string").alias("duracion_min"),
    )
    return airline.silver_flights(raw)


@query(
    """
    SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS aeropuerto_id, c_name AS nombre, c_mktsegment AS ciudad,
           CAST(c_nationkey AS VARCHAR) AS pais, c_acctbal / 100 AS lat, CAST(c_nationkey * 16 - 200 AS DOUBLE) AS lon
    FROM customer WHERE c_acctbal / 100 BETWEEN -90 AND 90 AND c_nationkey * 16 - 200 BETWEEN -180 AND 180
    """
)
def silver_places(t: Tables) -> DataFrame:
    """Customers as raw airports, some with impossible coordinates."""
    raw = t.customer.select(
        F.col("c_custkey").alias("aeropuerto_id"),
        F.col("c_name").alias("nombre"),
        F.col("c_mktsegment").alias("ciudad"),
        F.col("c_nationkey").alias("pais"),
        (F.col("c_acctbal") / 100).alias("lat"),
        (F.col("c_nationkey") * 16.0 - 200.0).alias("lon"),
    )
    return airline.silver_airports(raw)


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS aeronave_id, p_name AS modelo, p_brand AS fabricante,
           p_size AS anio_fabricacion
    FROM part WHERE p_size <= 40
    """
)
def silver_parts(t: Tables) -> DataFrame:
    """Parts as raw aircraft; a size over 40 is written as text that is no year."""
    raw = t.part.select(
        F.col("p_partkey").alias("aeronave_id"),
        F.col("p_name").alias("modelo"),
        F.col("p_brand").alias("fabricante"),
        F.when(F.col("p_size") <= 40, F.col("p_size").cast("string")).otherwise("n/a").alias("anio_fabricacion"),
    )
    return airline.silver_aircraft(raw)


@query(
    """
    SELECT * EXCLUDE place FROM (
        SELECT *, row_number() OVER (PARTITION BY mantenimiento_id ORDER BY aeronave_id DESC, fecha DESC, tipo DESC,
            costo_usd DESC, duracion_hr DESC) AS place
        FROM (SELECT l_orderkey || '-' || l_linenumber AS mantenimiento_id, CAST(l_suppkey AS VARCHAR) AS aeronave_id,
            CAST(l_shipdate AS DATE) AS fecha, l_returnflag AS tipo, l_extendedprice AS costo_usd,
            l_quantity AS duracion_hr FROM lineitem))
    WHERE place = 1
    """
)
def silver_maintenance(t: Tables) -> DataFrame:
    raw = t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("mantenimiento_id"),
        F.col("l_suppkey").alias("aeronave_id"),
        F.col("l_shipdate").alias("fecha"),
        F.col("l_returnflag").alias("tipo"),
        F.col("l_extendedprice").alias("costo_usd"),
        F.col("l_quantity").alias("duracion_hr"),
    )
    return airline.silver_maintenance(raw)


BIRTH_DAY_SQL = "(DATE '1960-01-01' + CAST(floor(c_acctbal) AS INTEGER))"


@query(
    f"""
    SELECT customer_id, {_sql_parse("day_text")} AS date_of_birth, name, split_part(name, ', ', 1) AS last_name,
           split_part(name, ', ', 2) AS first_name,
           coalesce(borough, '') || ', ' || coalesce(neighborhood, '') || ', ' || coalesce(zip_code, '') AS address
    FROM (SELECT c_custkey AS customer_id, {_sql_mixed(BIRTH_DAY_SQL, "c_mktsegment", SEGMENTS)} AS day_text,
            CASE WHEN c_nationkey = 3 THEN trim(split_part(c_name, '#', 1))
                 ELSE split_part(c_name, '#', 1) || ', ' || split_part(c_name, '#', 2) END AS name,
            c_mktsegment AS borough, CASE WHEN c_nationkey < 20 THEN 'Nation ' || c_nationkey END AS neighborhood,
            CAST(c_nationkey AS VARCHAR) AS zip_code FROM customer)
    WHERE {_sql_parse("day_text")} IS NOT NULL AND split_part(name, ', ', 2) <> ''
    """
)
def silver_customers(t: Tables) -> DataFrame:
    """Customers as raw insured persons: mixed birth dates, some names without a first name."""
    day = F.date_add(F.lit("1960-01-01").cast("date"), F.floor("c_acctbal").cast("int"))
    family, given = name_part("c_name", 0, "#"), name_part("c_name", 1, "#")
    raw = t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        _mixed_dates(day, "c_mktsegment", SEGMENTS).alias("date_of_birth"),
        F.when(F.col("c_nationkey") == 3, F.concat(family, F.lit(" ")))
        .otherwise(F.concat_ws(", ", family, given))
        .alias("name"),
        F.col("c_mktsegment").alias("borough"),
        F.when(F.col("c_nationkey") < 20, F.concat_ws(" ", F.lit("Nation"), "c_nationkey")).alias("neighborhood"),
        F.col("c_nationkey").alias("zip_code"),
    )
    return claims.silver_customers(raw).drop("borough", "neighborhood", "zip_code")


def _raw_policies(t: Tables) -> DataFrame:
    """Orders as raw policies: negative premiums, ends before the start, malformed ends."""
    day = F.col("o_orderdate").cast("date")
    end = F.date_add(day, F.when(F.col("o_orderpriority") == "1-URGENT", -5).otherwise(365)).cast("string")
    malformed = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    return t.orders.select(
        F.col("o_orderkey").alias("POLICY_NO"),
        F.col("o_custkey").alias("CUST_ID"),
        F.round(F.col("o_totalprice") - 50000, 2).cast("string").alias("PREMIUM"),
        day.cast("string").alias("POL_EFF_DATE"),
        F.when(malformed, "soon").otherwise(end).alias("POL_EXPIRY_DATE"),
    )


@query(
    """
    SELECT * FROM (
        SELECT o_orderkey AS POLICY_NO, o_custkey AS CUST_ID, round(o_totalprice - 50000, 2) AS PREMIUM,
            CAST(o_orderdate AS DATE) AS POL_EFF_DATE,
            CASE WHEN o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE)
                + CASE WHEN o_orderpriority = '1-URGENT' THEN -5 ELSE 365 END END AS POL_EXPIRY_DATE FROM orders)
    WHERE PREMIUM >= 0 AND POL_EFF_DATE <= POL_EXPIRY_DATE
    """
)
def silver_policies(t: Tables) -> DataFrame:
    return claims.silver_policies(_raw_policies(t))


def _raw_claims(t: Tables) -> DataFrame:
    """Order lines as raw claims, with malformed license dates and a column to drop."""
    day = F.col("l_shipdate").cast("date")
    issued = F.when(F.col("l_returnflag") == "N", "none").otherwise(F.date_sub(day, 900).cast("string"))
    return t.lineitem.select(
        F.col("l_partkey").alias("claim_no"),
        F.col("l_orderkey").alias("policy_no"),
        day.cast("string").alias("claim_date"),
        issued.alias("license_issue_date"),
        F.round(F.col("l_extendedprice") - 20000, 2).alias("total"),
        (F.col("l_linenumber") - 1).alias("age"),
        day.alias("date_1"),
    )


@query(
    """
    SELECT l_partkey AS claim_no, l_orderkey AS policy_no, CAST(l_shipdate AS DATE) AS claim_date,
           CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) - 900 END AS license_issue_date,
           round(l_extendedprice - 20000, 2) AS total, l_linenumber - 1 AS age
    FROM lineitem WHERE l_partkey IS NOT NULL AND l_orderkey IS NOT NULL
        AND round(l_extendedprice - 20000, 2) >= 0 AND l_linenumber > 1
    """
)
def silver_claims(t: Tables) -> DataFrame:
    return claims.silver_claims(_raw_claims(t))


def _raw_telematics(t: Tables) -> DataFrame:
    """Events as raw telematics, some off the globe or with a negative speed."""
    return t.events.select(
        "event_id",
        F.col("user_id").alias("chassis_no"),
        F.col("ts").cast("string").alias("event_timestamp"),
        F.round(F.col("value") - 50, 2).alias("latitude"),
        F.round(F.col("value") * 2 - 90, 2).alias("longitude"),
        F.round(F.col("value") - 5, 2).alias("speed"),
    )


@query(
    """
    SELECT event_id, chassis_no, event_timestamp, latitude, longitude, speed FROM (
        SELECT event_id, user_id AS chassis_no, ts AS event_timestamp, round(value - 50, 2) AS latitude,
            round(value * 2 - 90, 2) AS longitude, round(value - 5, 2) AS speed FROM events)
    WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND speed >= 0
    """
)
def silver_events(t: Tables) -> DataFrame:
    clean = claims.silver_telematics(_raw_telematics(t))
    return clean.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def _broken_accounts(t: Tables) -> DataFrame:
    """Customers as CSV text: every tenth line is cut short, every tenth has a value too many, every tenth a balance that is no number."""
    path = scratch_path(t.spark, "accounts")
    part = F.col("c_custkey") % 10
    balance = F.when(part == 2, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    whole = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", balance, "c_mktsegment")
    short = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name")
    line = F.when(part == 0, short).when(part == 1, F.concat(whole, F.lit(",more"))).otherwise(whole)
    t.customer.select(line.alias("value")).write.text(path)
    read = read_csv_kept(t.spark, path, ["custkey", "name", "balance", "segment"], header=False)
    checks = Checks({"custkey": "bigint", "balance": "double"}, {"no_custkey": present("custkey"), "balance": within("balance", 0)})
    return judge(read, checks, CORRUPT)


def _rejected_sql(source: str, table: str, columns: str, reasons: dict[str, str], lost: dict[str, str]) -> str:
    """Rows of the report on one source: reasons and lost values are conditions over ``columns``."""
    any_reason = " OR ".join(f"({c})" for c in reasons.values())
    counts = {"read": "true", "accepted": f"NOT ({any_reason})", "rejected": any_reason}
    counts |= {f"rejected:{r}": c for r, c in reasons.items()} | {f"lost:{c}": fails for c, fails in lost.items()}
    raw = f"(SELECT {columns} FROM {table})"
    return " UNION ALL ".join(f"SELECT '{source}' AS source, '{r}' AS rule, count(*) FILTER (WHERE {c}) AS n_rows FROM {raw}" for r, c in counts.items())


REJECTED_SQL = " UNION ALL ".join(
    [
        _rejected_sql(
            "policies", "orders",
            "round(o_totalprice - 50000, 2) AS premium, o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AS soon, o_orderpriority = '1-URGENT' AS early",
            {"no_policy_no": "false", "no_cust_id": "false", "premium": "premium < 0", "ends_before_start": "soon OR early"},
            {"PREMIUM": "false", "POL_EFF_DATE": "false", "POL_EXPIRY_DATE": "soon"},
        ),
        _rejected_sql(
            "claims", "lineitem", "l_returnflag, round(l_extendedprice - 20000, 2) AS total, l_linenumber - 1 AS age",
            {"no_claim_no": "false", "no_policy_no": "false", "total": "total < 0", "age": "age <= 0"},
            {"claim_date": "false", "license_issue_date": "l_returnflag = 'N'"},
        ),
        _rejected_sql(
            "telematics", "events", "round(value - 50, 2) AS latitude, round(value * 2 - 90, 2) AS longitude, round(value - 5, 2) AS speed",
            {"no_chassis_no": "false", "latitude": "abs(latitude) > 90", "longitude": "abs(longitude) > 180", "speed": "speed < 0"},
            {"event_timestamp": "false"},
        ),
        _rejected_sql(
            "accounts", "customer", "c_custkey % 10 AS part, c_acctbal",
            {MALFORMED: "part IN (0, 1)", "no_custkey": "false", "balance": "part NOT IN (0, 1) AND (part = 2 OR c_acctbal < 0)"},
            {"custkey": "false", "balance": "part = 2"},
        ),
    ]
)


@query(REJECTED_SQL)
def rejected_rows(t: Tables) -> DataFrame:
    """Rows read, accepted and rejected, by reason, of four raw sources, one of them a broken CSV file."""
    raw = {"policies": _raw_policies(t), "claims": _raw_claims(t), "telematics": _raw_telematics(t)}
    reports = []
    for source, df in raw.items():
        checks = claims.silver_checks(f"{source}_clean")
        reports.append(rejection_report(claims.judged_rows(f"{source}_clean", df), list(checks.keep), list(checks.types)).withColumn("source", F.lit(source)))
    broken = rejection_report(_broken_accounts(t), [MALFORMED, "no_custkey", "balance"], ["custkey", "balance"])
    reports.append(broken.withColumn("source", F.lit("accounts")))
    return functools.reduce(DataFrame.unionByName, reports)


@query(
    """
    SELECT c_custkey % 10 AS part, count(*) AS n_rows,
           CASE WHEN c_custkey % 10 IN (0, 1) THEN 'malformed_record' ELSE 'balance' END AS reasons, count(*) FILTER (WHERE c_custkey % 10 < 2) AS with_text
    FROM customer WHERE c_custkey % 10 IN (0, 1, 2) OR c_acctbal < 0 GROUP BY ALL
    """
)
def quarantined_accounts(t: Tables) -> DataFrame:
    """The quarantine of the broken CSV file: reasons, and the text of malformed records."""
    kept = quarantine(_broken_accounts(t))
    key = F.coalesce(F.split(CORRUPT, ",")[0], F.col("custkey").cast("string")).cast("bigint")
    grouped = kept.groupBy((key % 10).alias("part"), F.array_join("reject_reasons", ",").alias("reasons"))
    return grouped.agg(F.count("*").alias("n_rows"), F.count(CORRUPT).alias("with_text"))

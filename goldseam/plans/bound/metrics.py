"""Grouped KPIs and distributions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldseam.functions.scores import confidence_tier
from goldseam.operators import aggregates as agg
from goldseam.operators import measures as ms
from goldseam.operators.aggregates import kpi, mean, overview, present, rows, total
from goldseam.operators.joins import enrich
from goldseam.plans import sales
from goldseam.plans.bound.registry import Tables, query, sql_mean, sql_pct, sql_sum, sql_units
from goldseam.session import scratch_path


@query(
    f"""
    SELECT n_name, c_mktsegment, CAST(month(o_orderdate) AS INTEGER) AS order_month,
           CAST(year(o_orderdate) AS INTEGER) AS order_year, count(o_orderkey) AS total_orders,
           count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, count(*) FILTER (WHERE o_orderstatus = 'O') AS open,
           count(*) FILTER (WHERE o_orderstatus = 'P') AS pending, {sql_mean("o_totalprice")} AS mean_price,
           {sql_pct("count(*) FILTER (WHERE o_orderstatus = 'F')", "count(o_orderkey)")} AS finished_pct
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    GROUP BY ALL
    """
)
def kpi_punctuality(t: Tables) -> DataFrame:
    """Orders by state, mean price and share finished per nation, segment and month."""
    placed = enrich(t.customer, t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"])
    status = F.col("o_orderstatus")
    return kpi(
        t.orders.withColumns({"order_month": F.month("o_orderdate"), "order_year": F.year("o_orderdate")}),
        ["n_name", "c_mktsegment", "order_month", "order_year"],
        {
            "total_orders": ms.count_present("o_orderkey"),
            "finished": ms.count_where(status == "F"),
            "open": ms.count_where(status == "O"),
            "pending": ms.count_where(status == "P"),
            "mean_price": ms.mean("o_totalprice"),
        },
        {"finished_pct": ("finished", "total_orders")},
        [ms.Dimension(placed, {"o_custkey": "c_custkey"}, ["n_name", "c_mktsegment"])],
    )


@query(
    f"""
    SELECT l_suppkey, s_nationkey, p_brand, p_type, CAST(month(l_shipdate) AS INTEGER) AS ship_month,
           CAST(year(l_shipdate) AS INTEGER) AS ship_year, count(l_orderkey) AS total_jobs,
           {sql_mean("l_extendedprice")} AS mean_cost, {sql_sum("l_extendedprice")} AS total_cost,
           {sql_mean("l_quantity", 2)} AS mean_hours, {sql_sum("l_quantity")} AS total_hours
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey
    GROUP BY ALL
    """
)
def kpi_maintenance(t: Tables) -> DataFrame:
    """Jobs, cost and hours per supplier, part kind and month."""
    return kpi(
        t.lineitem.withColumns({"ship_month": F.month("l_shipdate"), "ship_year": F.year("l_shipdate")}),
        ["l_suppkey", "s_nationkey", "p_brand", "p_type", "ship_month", "ship_year"],
        {
            "total_jobs": ms.count_present("l_orderkey"),
            "mean_cost": ms.mean("l_extendedprice"),
            "total_cost": ms.total("l_extendedprice"),
            "mean_hours": ms.mean("l_quantity"),
            "total_hours": ms.total("l_quantity", 0),
        },
        dimensions=[
            ms.Dimension(t.supplier, {"l_suppkey": "s_suppkey"}, ["s_nationkey"]),
            ms.Dimension(t.part, {"l_partkey": "p_partkey"}, ["p_brand", "p_type"]),
        ],
    )


@query(
    f"""
    SELECT user_id, {sql_mean("value")} AS avg_speed, round(max(value), 2) AS max_speed,
           round(min(value), 2) AS min_speed, {sql_mean("value", 6)} AS avg_position, count(*) AS total_events,
           min(ts) AS first_event, max(ts) AS last_event
    FROM events GROUP BY user_id
    """
)
def telematics_by_user(t: Tables) -> DataFrame:
    return kpi(
        t.events,
        ["user_id"],
        {
            "avg_speed": mean("value", 2, exact=True),
            "max_speed": F.round(F.max("value"), 2),
            "min_speed": F.round(F.min("value"), 2),
            "avg_position": mean("value", 6, exact=True),
            "total_events": rows(),
            "first_event": F.min("ts"),
            "last_event": F.max("ts"),
        },
    )


@query("SELECT label, count(*) AS n FROM embeddings GROUP BY label")
def label_counts(t: Tables) -> DataFrame:
    return agg.count_by(t.embeddings, ["label"])


@query(
    f"""
    WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type),
         s AS (SELECT sum(n) AS rows, min(n) AS least FROM c)
    SELECT event_type, n, {sql_pct("n", "rows")} AS pct, {sql_pct("n", "rows")} < 5 AS is_minority,
           {sql_pct("least", "rows")} AS smallest_pct
    FROM c CROSS JOIN s
    """
)
def class_distribution(t: Tables) -> DataFrame:
    return agg.class_distribution(t.events, "event_type")


TIER_SQL = "CASE WHEN value / 100 >= 0.8 THEN 'alta' WHEN value / 100 >= 0.5 THEN 'media' ELSE 'baja' END"


@query(
    f"""
    SELECT event_id, value / 100 AS score, {TIER_SQL} AS tier, value / 100 >= 0.5 AS is_reliable FROM events
    """
)
def confidence_tiers(t: Tables) -> DataFrame:
    scored = t.events.select("event_id", (F.col("value") / 100).alias("score"))
    return scored.select("*", confidence_tier("score").alias("tier"), (F.col("score") >= 0.5).alias("is_reliable"))


@query(
    f"""
    SELECT event_type, {TIER_SQL} AS tier, count(*) AS n, {sql_mean("value / 100", 4)} AS mean_score
    FROM events GROUP BY ALL
    """
)
def prediction_distribution(t: Tables) -> DataFrame:
    scored = t.events.select("event_type", (F.col("value") / 100).alias("score"))
    return kpi(
        scored.withColumn("tier", confidence_tier("score")),
        ["event_type", "tier"],
        {"n": rows(), "mean_score": mean("score", 4, exact=True)},
    )


@query(
    """
    SELECT l_suppkey, arg_max(l_linestatus, row(l_extendedprice, l_orderkey, l_linenumber, l_partkey)) AS l_linestatus,
           max(l_extendedprice) AS max_price, CAST(count(*) AS BIGINT) AS n,
           string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags
    FROM lineitem GROUP BY l_suppkey
    """
)
def dominant_label(t: Tables) -> DataFrame:
    return agg.best_by(
        t.lineitem,
        ["l_suppkey"],
        "l_linestatus",
        "l_extendedprice",
        ["l_orderkey", "l_linenumber", "l_partkey"],
        {
            "max_price": F.max("l_extendedprice"),
            "n": present("l_orderkey"),
            "flags": agg.distinct_list("l_returnflag"),
        },
    )


@query(
    f"""
    SELECT count(*) AS total_rows, count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS kinds,
           CAST(sum(CAST(value >= 50 AS INTEGER)) AS BIGINT) AS reliable, {sql_mean("value", 4)} AS mean_value,
           min(value) AS min_value, max(value) AS max_value, min(ts) AS first_ts, max(ts) AS last_ts
    FROM events
    """
)
def overall_stats(t: Tables) -> DataFrame:
    measures = {
        "total_rows": rows(),
        "reliable": F.sum((F.col("value") >= 50).cast("int")),
        "mean_value": mean("value", 4, exact=True),
        **{f"{side}_value": pick("value") for side, pick in (("min", F.min), ("max", F.max))},
        **{f"{side}_ts": pick("ts") for side, pick in (("first", F.min), ("last", F.max))},
    }
    return overview(t.events, measures, {"users": "user_id", "kinds": "event_type"})


MONTHLY_SQL = f"""
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS mes, p_brand, l_partkey,
           sum(l_quantity) AS unidades_vendidas, {sql_sum("l_quantity * l_extendedprice")} AS importe_total,
           {sql_mean("l_extendedprice")} AS precio_medio
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31'
"""


def _monthly(t: Tables, category: str) -> DataFrame:
    return sales.monthly_sales(
        t.lineitem,
        t.part,
        datetime(1996, 1, 1),
        datetime(1999, 12, 31),
        category,
        day="l_shipdate",
        product="l_partkey",
        units="l_quantity",
        price="l_extendedprice",
        name="p_partkey",
        group="p_brand",
    )


@query(MONTHLY_SQL + "GROUP BY ALL")
def monthly_sales(t: Tables) -> DataFrame:
    return _monthly(t, "All")


@query(MONTHLY_SQL + "AND p_brand = 'Brand#7' GROUP BY ALL")
def monthly_sales_category(t: Tables) -> DataFrame:
    return _monthly(t, "Brand#7")


@query(
    f"""
    SELECT o_orderpriority, {sql_sum("o_totalprice")} AS total
    FROM orders GROUP BY o_orderpriority ORDER BY 2 DESC, 1 LIMIT 3
    """
)
def top_priorities(t: Tables) -> DataFrame:
    return agg.top_groups(t.orders, "o_orderpriority", total("o_totalprice", 2, exact=True), 3)


@query("SELECT event_type, count(DISTINCT user_id) AS exact_n, true AS within FROM events GROUP BY event_type")
def distinct_rollup(t: Tables) -> DataFrame:
    """Users per kind of event from stored sketches of single days, against an exact count: within three standard errors."""
    path = scratch_path(t.spark, "user-sketches")
    daily = agg.distinct_sketches(t.events.withColumn("day", F.col("ts").cast("date")), ["day", "event_type"], "user_id")
    daily.write.parquet(path)
    merged = agg.distinct_from_sketches(t.spark.read.schema(daily.schema).parquet(path), ["event_type"], count_as="estimate")
    exact = t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact_n"))
    near = F.abs(F.col("estimate") - F.col("exact_n")) <= F.ceil(F.col("exact_n") * 3 * 1.04 / 2**6)
    return merged.join(exact, "event_type").select("event_type", "exact_n", near.alias("within"))

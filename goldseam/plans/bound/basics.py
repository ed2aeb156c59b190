"""Sources, projections, filters, joins between two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldseam.functions.sql_functions import register_threshold
from goldseam.operators import joins, shaping
from goldseam.operators.aggregates import distinct_values
from goldseam.plans import sales
from goldseam.plans.bound.registry import Tables, query, sql_sum
from goldseam.session import scratch_path
from goldseam.sources.readers import inline_rows, read_csv
from goldseam.sources.sinks import append_rows, projected_view, table_counts, write_verified


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def csv_roundtrip(t: Tables) -> DataFrame:
    """Orders written as CSV to the shared folder and scanned back with a declared schema."""
    kept = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(t.spark, "orders-csv")
    kept.write.option("header", True).csv(path)
    return read_csv(t.spark, path, kept.schema)


@query(
    """
    SELECT o_orderkey, o_orderpriority, d.level AS priority_level, d.urgent AS is_urgent
    FROM orders LEFT JOIN (VALUES ('1-URGENT', 1, true), ('2-HIGH', 2, true), ('3-MEDIUM', 3, false),
        ('5-LOW', 5, false)) AS d(priority, level, urgent) ON o_orderpriority = d.priority
    """
)
def inline_dim(t: Tables) -> DataFrame:
    levels = inline_rows(
        t.spark,
        [("1-URGENT", 1, True), ("2-HIGH", 2, True), ("3-MEDIUM", 3, False), ("5-LOW", 5, False)],
        "priority STRING, level INT, urgent BOOLEAN",
    )
    return joins.enrich(
        t.orders.select("o_orderkey", "o_orderpriority"),
        levels,
        {"o_orderpriority": "priority"},
        {"priority_level": "level", "is_urgent": "urgent"},
    )


@query(
    """
    SELECT * FROM customer
    UNION ALL SELECT CAST(-1 AS BIGINT), 'Customer#new', CAST(7 AS INTEGER), CAST(10.5 AS DOUBLE), 'MACHINERY'
    """,
    name="append_rows",
)
def customer_append(t: Tables) -> DataFrame:
    return append_rows(t.customer, [(-1, "Customer#new", 7, 10.5, "MACHINERY")])


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 150000")
def view_filter(t: Tables) -> DataFrame:
    return projected_view(
        t.orders, "large_orders", ["o_orderkey", "o_orderstatus"], F.col("o_totalprice") > 150000.0
    )


@query(
    """
    SELECT 'customer' AS table_name, count(*) AS rows FROM customer UNION ALL
    SELECT 'supplier', count(*) FROM supplier UNION ALL
    SELECT 'part', count(*) FROM part UNION ALL
    SELECT 'orders', count(*) FROM orders UNION ALL
    SELECT 'lineitem', count(*) FROM lineitem
    """,
    name="table_counts",
)
def layer_counts(t: Tables) -> DataFrame:
    names = ("customer", "supplier", "part", "orders", "lineitem")
    return table_counts({name: getattr(t, name) for name in names})


@query("SELECT o_orderkey, o_orderdate, o_orderstatus, o_totalprice FROM orders")
def project_orders(t: Tables) -> DataFrame:
    wanted = ["o_orderkey", "o_orderdate", "o_shipaddress", "o_orderstatus", "o_totalprice"]
    return shaping.keep_present(t.orders, wanted)


@query(
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_quantity * l_extendedprice AS line_total
    FROM lineitem
    """
)
def line_totals(t: Tables) -> DataFrame:
    kept = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return sales.line_totals(kept, "l_quantity", "l_extendedprice", "line_total")


@query("SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000")
def filter_orders(t: Tables) -> DataFrame:
    return shaping.filter_by(t.orders, o_orderstatus="F", o_orderpriority="All").filter("o_totalprice > 250000")


@query("SELECT * FROM orders WHERE o_totalprice > 120000")
def udf_threshold(t: Tables) -> DataFrame:
    above = register_threshold(t.spark, "above_threshold", 120000.0)
    return t.orders.filter(F.expr(f"{above}(o_totalprice)"))


@query(
    """
    SELECT event_id, user_id, value FROM events
    WHERE value IS NOT NULL AND value >= 5 AND value <= 100
    """
)
def valid_range(t: Tables) -> DataFrame:
    return shaping.valid_range(t.events, {"value": (5, 100)}).select("event_id", "user_id", "value")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, CAST(o_orderdate AS DATE) AS order_day,
           CAST(l_shipdate AS DATE) AS ship_day
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate <= l_shipdate
    """
)
def date_order_check(t: Tables) -> DataFrame:
    shipped = joins.enrich(t.lineitem, t.orders, {"l_orderkey": "o_orderkey"}, ["o_orderdate"], how="inner")
    return shaping.in_order(shipped, "o_orderdate", "l_shipdate").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        F.col("o_orderdate").cast("date").alias("order_day"),
        F.col("l_shipdate").cast("date").alias("ship_day"),
    )


@query(
    """
    SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    """
)
def labelled_documents(t: Tables) -> DataFrame:
    kept = t.documents.select("doc_id", "lang", "source")
    return joins.enrich(kept, t.labels, {"doc_id": "doc_id"}, ["quality", "toxic"], how="inner")


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def orphan_documents(t: Tables) -> DataFrame:
    documents = t.documents.select("doc_id", "lang", "source")
    return joins.orphans(documents, t.labels, "doc_id", joins.hot_keys(documents, "doc_id"))


@query(
    """
    WITH m AS (SELECT count(*) AS total, count(l.doc_id) AS matched
        FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id)
    SELECT total, matched, total - matched AS unmatched,
           CAST((2 * matched * 10000 + total) // (2 * total) AS DOUBLE) / 100 AS matched_pct FROM m
    """
)
def join_coverage(t: Tables) -> DataFrame:
    return joins.join_coverage(t.documents, t.labels, ["doc_id"])


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """
)
def duplicate_keys(t: Tables) -> DataFrame:
    return joins.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    """
    SELECT (SELECT count(*) FROM orders) AS rows_in, count(*) AS rows_out,
           count(*) - (SELECT count(*) FROM orders) AS added
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    """
)
def join_fan_out(t: Tables) -> DataFrame:
    widened = joins.enrich(t.orders, t.lineitem, {"o_orderkey": "l_orderkey"}, ["l_linenumber"])
    return joins.fan_out(t.orders, widened)


@query("SELECT DISTINCT p_type FROM part")
def distinct_products(t: Tables) -> DataFrame:
    return distinct_values(t.part, "p_type")


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def sample_orders(t: Tables) -> DataFrame:
    return shaping.sample_rows(
        t.orders,
        ["o_orderkey", "o_orderdate", "o_totalprice"],
        [F.desc("o_totalprice"), F.asc("o_orderkey")],
        10,
    )


@query(
    """
    SELECT round(avg(o_totalprice), 4) AS precio_medio FROM orders
    WHERE o_orderpriority = '1-URGENT' AND o_totalprice >= 50000
    """
)
def avg_price_param(t: Tables) -> DataFrame:
    mean = sales.average_price(t.orders, "1-URGENT", 50000.0, "o_orderpriority", "o_totalprice")
    return mean.select(F.round("precio_medio", 4).alias("precio_medio"))


@query(
    """
    SELECT round(avg(p_retailprice), 4) AS precio_medio FROM part
    WHERE p_type = 'ECONOMY' AND p_retailprice >= CAST('950' AS DOUBLE)
    """
)
def avg_price_sql(t: Tables) -> DataFrame:
    t.part.select(F.col("p_type").alias("producto"), F.col("p_retailprice").alias("precio")).createOrReplaceTempView(
        "productos"
    )
    mean = sales.average_price_sql(t.spark, "productos", "ECONOMY", "950")
    return mean.select(F.round("precio_medio", 4).alias("precio_medio"))


@query(
    f"""
    SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS total_units, {sql_sum("o_totalprice")} AS total_sales_amount
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
    """
)
def sales_by_segment(t: Tables) -> DataFrame:
    sold = t.orders.withColumn("units", F.lit(1).cast("bigint"))
    return sales.sales_by_dim(
        sold, t.customer, ("o_custkey", "c_custkey"), "c_mktsegment", "units", "o_totalprice"
    )


@query(
    f"""
    SELECT l_returnflag, sum(l_quantity) AS total_units, {sql_sum("l_quantity * l_extendedprice")} AS total_sales_amount
    FROM lineitem GROUP BY l_returnflag
    """
)
def sales_by_flag(t: Tables) -> DataFrame:
    sold = sales.line_totals(t.lineitem, "l_quantity", "l_extendedprice")
    return sales.sales_by(sold, "l_returnflag", "l_quantity", "total_sales")


@query(
    f"""
    SELECT l_returnflag, sum(l_quantity) AS total_units,
        {sql_sum("l_extendedprice * (1 - l_discount) * (1 + l_tax)")} AS total_sales_amount
    FROM lineitem GROUP BY l_returnflag
    """
)
def charges_by_flag(t: Tables) -> DataFrame:
    """Amounts of six decimals: no row may be rounded before it is added."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return sales.sales_by(t.lineitem.withColumn("charge", charge), "l_returnflag", "l_quantity", "charge")


@query(
    """
    SELECT event_id, CASE WHEN event_id % 5 < 3 THEN NULL ELSE value END AS value
    FROM events
    """
)
def finite_values(t: Tables) -> DataFrame:
    """NaN and infinity, put in by key, become NULL when typed."""
    kind = F.col("event_id") % 5
    odd = F.when(kind == 0, float("nan")).when(kind == 1, float("inf")).when(kind == 2, float("-inf")).otherwise(F.col("value"))
    return shaping.conform(t.events.select("event_id", odd.alias("value")), {"value": "double"})


@query(
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, top_price, n_lines FROM lineitem
    LEFT JOIN (SELECT l_suppkey AS k, max(l_extendedprice) AS top_price, count(*) AS n_lines FROM lineitem WHERE l_suppkey % 3 > 0 GROUP BY l_suppkey) ON l_suppkey = k
    """
)
def enrich_hot_keys(t: Tables) -> DataFrame:
    """Order lines with facts of their supplier, an aggregate that adaptive execution cannot split: hot suppliers are joined apart."""
    facts = t.lineitem.filter("l_suppkey % 3 > 0").groupBy("l_suppkey").agg(F.max("l_extendedprice").alias("top_price"), F.count("*").alias("n_lines"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    hot = joins.hot_keys(lines, "l_suppkey", 1e-3, 100)
    return joins.enrich(lines, facts, {"l_suppkey": "l_suppkey"}, ["top_price", "n_lines"], hot=hot)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 3000)")
def orphans_hot_keys(t: Tables) -> DataFrame:
    """Orders of customers who are not well off; the customers with most orders are joined apart."""
    orders = t.orders.select("o_orderkey", "o_custkey")
    known = t.customer.filter("c_acctbal > 3000").select(F.col("c_custkey").alias("o_custkey"))
    return joins.orphans(orders, known, "o_custkey", joins.hot_keys(orders, "o_custkey", 1e-3, 10))


@query("SELECT count(*) AS rows_written, count(*) AS rows_read, true AS same FROM lineitem")
def verified_write(t: Tables) -> DataFrame:
    """Order lines written, read back, and compared by count and by a checksum of all rows."""
    return write_verified(t.lineitem, scratch_path(t.spark, "verified"))

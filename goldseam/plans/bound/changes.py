"""Updates, deletes, upserts and change logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldseam.operators import changes
from goldseam.plans.bound.registry import SCHEMAS, Tables, query
from goldseam.session import scratch_path
from goldseam.sources.files import change_files, read_current


@query(
    """
    WITH s AS (SELECT 2 * c_custkey AS k, c_name || ' (new)' AS name, c_nationkey AS nation,
                      round(c_acctbal + 1, 2) AS bal, CAST(NULL AS VARCHAR) AS seg FROM customer)
    SELECT c_custkey, CASE WHEN k IS NULL THEN c_name ELSE name END AS c_name,
           CASE WHEN k IS NULL THEN c_nationkey ELSE nation END AS c_nationkey,
           CASE WHEN k IS NULL THEN c_acctbal ELSE bal END AS c_acctbal,
           CASE WHEN k IS NULL THEN c_mktsegment ELSE seg END AS c_mktsegment
    FROM customer LEFT JOIN s ON c_custkey = k
    UNION ALL
    SELECT k, name, nation, bal, seg FROM s WHERE k NOT IN (SELECT c_custkey FROM customer)
    """
)
def merge_customers(t: Tables) -> DataFrame:
    """Every customer offered again under twice its key, as text: half update, half insert."""
    news = t.customer.select(
        (F.col("c_custkey") * 2).cast("string").alias("c_custkey"),
        F.concat("c_name", F.lit(" (new)")).alias("c_name"),
        "c_nationkey",
        F.round(F.col("c_acctbal") + 1, 2).alias("c_acctbal"),
        F.lit(None).cast("string").alias("c_mktsegment"),
    )
    return changes.upsert(t.customer, news, ["c_custkey"])


@query(
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderpriority = '1-URGENT' THEN round(o_totalprice / 2, 4) ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderpriority
    FROM orders
    """
)
def update_orders(t: Tables) -> DataFrame:
    return changes.update_where(
        t.orders,
        F.col("o_orderpriority") == "1-URGENT",
        {"o_orderstatus": F.lit("F"), "o_totalprice": F.round(F.col("o_totalprice") / 2, 4)},
    )


@query("SELECT * FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 100000)")
def delete_orders(t: Tables) -> DataFrame:
    return changes.delete_where(t.orders, (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 100000))


def _stored_orders(t: Tables) -> str:
    """A copy of the orders, a folder per priority and several files in each."""
    path = scratch_path(t.spark, "orders")
    t.orders.repartition(4, "o_orderstatus").write.partitionBy("o_orderpriority").parquet(path)
    return path


@query("SELECT * FROM orders WHERE NOT (o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' AND o_totalprice < 100000)")
def delete_stored_orders(t: Tables) -> DataFrame:
    """Deletes from a stored, partitioned copy: only files with such rows are written again."""
    path = _stored_orders(t)
    gone = (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 100000)
    change_files(t.spark, path, gone, lambda df: changes.delete_where(df, gone), ["o_orderpriority"])
    return read_current(t.spark, path, SCHEMAS["orders"])


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_custkey % 50 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
           o_orderdate, CASE WHEN o_custkey % 50 = 0 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
    FROM orders
    """
)
def update_stored_orders(t: Tables) -> DataFrame:
    """Updates rows of a stored copy, which moves them to another partition; asked for twice under one id."""
    path = _stored_orders(t)
    hit = F.col("o_custkey") % 50 == 0
    sets = {"o_totalprice": F.col("o_totalprice") * 2, "o_orderpriority": F.lit("1-URGENT")}
    for _ in range(2):
        change_files(t.spark, path, hit, lambda df: changes.update_where(df, hit, sets), ["o_orderpriority"], "double")
    return read_current(t.spark, path, SCHEMAS["orders"])


def _log(t: Tables) -> DataFrame:
    """Events as the change log of a table of users; an error deletes the user's row."""
    return t.events.select(
        "user_id",
        "event_type",
        "value",
        F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("op"),
        F.col("event_id").alias("version"),
        "ts",
    )


@query(
    """
    SELECT user_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place FROM events
        WHERE ts <= TIMESTAMP '2024-01-20 12:00:00')
    WHERE place = 1 AND event_type <> 'error'
    """
)
def events_as_of(t: Tables) -> DataFrame:
    return changes.as_of(_log(t), ["user_id"], ts="2024-01-20 12:00:00")


@query(
    """
    SELECT user_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place FROM events
        WHERE event_id <= 6000)
    WHERE place = 1 AND event_type <> 'error'
    """
)
def events_as_of_version(t: Tables) -> DataFrame:
    return changes.as_of(_log(t), ["user_id"], version=6000)


@query(
    """
    SELECT CAST(ts AS DATE) AS day, event_type AS op, count(*) AS n_changes, min(ts) AS first_ts, max(ts) AS last_ts
    FROM events GROUP BY 1, 2
    """
)
def change_history(t: Tables) -> DataFrame:
    log = t.events.select(F.col("ts").cast("date").alias("day"), F.col("event_type").alias("op"), "ts")
    return changes.change_history(log, ["day", "op"])


@query(
    """
    SELECT user_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place FROM events
        WHERE event_id <= (SELECT max(event_id) * 3 // 5 FROM events))
    WHERE place = 1 AND event_type <> 'error'
    """
)
def events_as_of_snapshot(t: Tables) -> DataFrame:
    """The table of users at a version, from the last snapshot before it rather than from the whole log."""
    log, path = _log(t), scratch_path(t.spark, "snapshots")
    version = log.agg(F.max("version")).first()[0] * 3 // 5
    span = version // 2 + 1
    epochs = changes.write_snapshots(log, ["user_id"], path, span)
    return changes.as_of_snapshot(log, ["user_id"], path, span, epochs, version)

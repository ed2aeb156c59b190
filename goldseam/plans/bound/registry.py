"""Registration of bound queries, and the SQL snippets their checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from goldseam.sources.readers import read_parquet


SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


class Tables:
    """The tables of one folder as attributes, e.g. ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return read_parquet(self.spark, f"{self.folder}/{name}.parquet", schema=SCHEMAS[name])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables`` under its own or a given name, with the SQL it must agree with."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or build.__name__
        QUERIES[key] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register


def sql_units(x: str) -> str:
    """Whole numbers of the tenth decimal, which no value of the test tables goes past by more than a double's error."""
    return f"CAST(round(({x}) * 10000000000) AS HUGEINT)"


def sql_sum(x: str, digits: int = 2) -> str:
    """Exact sum of numbers that add up to no less than zero, rounded at the end."""
    return sql_div(f"sum({sql_units(x)})", str(10 ** (10 - digits)), digits)


def sql_div(a: str, b: str, digits: int) -> str:
    """Half-up quotient of non-negative whole numbers, ``a`` counting 10^-digits."""
    return f"(CAST((2 * ({a}) + ({b})) // (2 * nullif({b}, 0)) AS DOUBLE) / {10**digits})"


def sql_mean(x: str, digits: int = 2) -> str:
    """Exact half-up mean of non-negative numbers."""
    return sql_div(f"sum({sql_units(x)})", f"(count({x}) * {10 ** (10 - digits)})", digits)


def sql_pct(part: str, total: str) -> str:
    return sql_div(f"({part}) * 10000", total, 2)

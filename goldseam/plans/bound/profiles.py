"""Exploratory statistics and data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldseam.operators import profile, quality, quantiles
from goldseam.operators.shaping import conform
from goldseam.plans.bound.registry import Tables, query, sql_pct
from goldseam.session import scratch_path

NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    """
    SELECT column_name, column_type, CAST(11 AS INTEGER) AS n_columns, (SELECT count(*) FROM lineitem) AS n_rows
    FROM (VALUES ('l_orderkey', 'bigint'), ('l_partkey', 'bigint'), ('l_suppkey', 'bigint'), ('l_linenumber', 'int'),
        ('l_quantity', 'double'), ('l_extendedprice', 'double'), ('l_discount', 'double'), ('l_tax', 'double'),
        ('l_returnflag', 'string'), ('l_linestatus', 'string'), ('l_shipdate', 'timestamp_ntz'))
        AS d(column_name, column_type)
    """
)
def profile_shape(t: Tables) -> DataFrame:
    return profile.profile_shape(t.lineitem)


def _sql_nulls(table: str, columns: dict[str, bool]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
        + (f"count(*) FILTER (WHERE isnan({c}))" if floating else "CAST(0 AS BIGINT)")
        + f" AS n_nan, count(*) AS n_rows FROM {table}"
        for c, floating in columns.items()
    )


@query(
    _sql_nulls(
        "(SELECT d.doc_id, CAST(n_chars AS DOUBLE) AS n_chars, quality, toxic "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)",
        {"doc_id": False, "n_chars": True, "quality": False, "toxic": False},
    )
)
def null_profile(t: Tables) -> DataFrame:
    """Documents with their labels, many of which are missing."""
    labelled = t.documents.join(t.labels, "doc_id", "left")
    return profile.null_profile(
        labelled.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"), "quality", "toxic")
    )


def _sql_stats(extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS stddev, min({c}) + 0.0::DOUBLE AS min, {extra.format(c=c)} "
        f"max({c}) + 0.0::DOUBLE AS max FROM lineitem"
        for c in NUMBERS
    )


@query(_sql_stats())
def describe_numeric(t: Tables) -> DataFrame:
    return profile.describe_numeric(t.lineitem, NUMBERS)


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, min({c}) AS min, max({c}) AS max FROM orders"
        for c in ("o_orderstatus", "o_orderpriority")
    )
)
def describe_text(t: Tables) -> DataFrame:
    return profile.describe_text(t.orders)


@query(
    _sql_stats(
        "quantile_disc({c}, 0.25) AS q1, quantile_disc({c}, 0.5) AS median, quantile_disc({c}, 0.75) AS q3,"
    )
)
def summary_numeric(t: Tables) -> DataFrame:
    return profile.summary_numeric(t.lineitem, NUMBERS)


@query(
    " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM lineitem"
        for i, a in enumerate(NUMBERS)
        for b in NUMBERS[:i]
    )
)
def corr_matrix(t: Tables) -> DataFrame:
    return profile.corr_matrix(t.lineitem, NUMBERS)


@query(
    """
    WITH q AS (SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM events)
    SELECT event_id, user_id, event_type, value FROM events, q
    WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)
    """
)
def iqr_outliers(t: Tables) -> DataFrame:
    return profile.iqr_outliers(t.events, "value").select("event_id", "user_id", "event_type", "value")


@query(
    """
    WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS d FROM events)
    SELECT event_id, value, round((value - m) / d, 6) AS zscore FROM events, s WHERE abs((value - m) / d) > 3
    """
)
def zscore_outliers(t: Tables) -> DataFrame:
    found = profile.zscore_outliers(t.events, "value")
    return found.select("event_id", "value", F.round("zscore", 6).alias("zscore"))


@query(
    f"""
    WITH c AS (
        SELECT count(*) AS total, count(*) FILTER (WHERE o_totalprice < 1000) AS low_price,
            count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS unfinished,
            count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1995-06-01') AS early,
            count(*) FILTER (WHERE o_custkey IS NULL) AS no_customer,
            count(*) FILTER (WHERE trim(o_orderpriority) = '') AS blank_priority FROM orders)
    SELECT rule, failures, total, {sql_pct("failures", "total")} AS failed_pct
    FROM (SELECT total, unnest(['low_price', 'unfinished', 'early', 'no_customer', 'blank_priority']) AS rule,
            unnest([low_price, unfinished, early, no_customer, blank_priority]) AS failures FROM c)
    """
)
def quality_report(t: Tables) -> DataFrame:
    return quality.quality_report(
        t.orders,
        {
            "low_price": F.col("o_totalprice") < 1000,
            "unfinished": ~F.col("o_orderstatus").isin("F", "O"),
            "early": F.col("o_orderdate") < F.lit("1995-06-01").cast("timestamp_ntz"),
            "no_customer": F.col("o_custkey").isNull(),
            "blank_priority": F.trim("o_orderpriority") == "",
        },
    )


@query(
    """
    WITH s AS (SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL)
    SELECT CAST(sum(copies) AS BIGINT) AS n_rows,
        CAST(coalesce(sum(copies) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL), 0) AS BIGINT)
            AS null_key_rows,
        count(*) FILTER (WHERE copies > 1) AS duplicate_keys,
        CAST(coalesce(sum(copies - 1) FILTER (WHERE copies > 1), 0) AS BIGINT) AS surplus_rows FROM s
    """
)
def quality_keys(t: Tables) -> DataFrame:
    return quality.key_report(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) + 0.0::DOUBLE AS min_value, "
        f"CAST(max({c}) AS DOUBLE) + 0.0::DOUBLE AS max_value "
        "FROM lineitem"
        for c in (*NUMBERS, "l_linenumber")
    )
)
def value_ranges(t: Tables) -> DataFrame:
    return quality.value_ranges(t.lineitem, [*NUMBERS, "l_linenumber"])


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS present, count(*) - count({c}) AS missing, "
        f"{sql_pct(f'count({c})', 'count(*)')} AS present_pct "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
        for c in ("quality", "toxic")
    )
)
def key_coverage(t: Tables) -> DataFrame:
    return quality.key_coverage(t.documents.join(t.labels, "doc_id", "left"), ["quality", "toxic"])


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
           o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
           TRY_CAST(substr(o_orderpriority, 3) AS INTEGER) AS o_orderpriority
    FROM orders
    """
)
def bronze_conform(t: Tables) -> DataFrame:
    """Orders as text, typed again; a priority without a number becomes NULL."""
    raw = t.orders.select(
        *(F.col(c).cast("string").alias(c) for c in t.orders.columns if c != "o_orderpriority"),
        F.substring("o_orderpriority", 3, 100).alias("o_orderpriority"),
    )
    return conform(
        raw,
        {
            "o_orderkey": "string",
            "o_custkey": "string",
            "o_orderstatus": "string",
            "o_totalprice": "double",
            "o_orderdate": "date",
            "o_orderpriority": "int",
        },
    )


SKETCHED, RANK_ERROR, PROBS = ("l_quantity", "l_extendedprice", "l_discount"), 0.01, (0.25, 0.5, 0.75)


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {p} AS prob, CAST(count({c}) AS BIGINT) AS n, true AS within FROM lineitem" for c in SKETCHED for p in PROBS
    )
)
def quantile_rank_error(t: Tables) -> DataFrame:
    """Quartiles from stored sketches of single days, merged: whether their exact ranks are within the stated error."""
    path = scratch_path(t.spark, "sketches")
    daily = quantiles.quantile_sketches(t.lineitem.withColumn("day", F.col("l_shipdate").cast("date")), ["day"], SKETCHED, RANK_ERROR)
    daily.write.parquet(path)
    merged = quantiles.quantiles_from_sketches(t.spark.read.schema(daily.schema).parquet(path), [], SKETCHED, PROBS)
    found = merged.first()
    rows = []
    for c in SKETCHED:
        for k, p in enumerate(PROBS):
            n, low, high = F.count(c), F.count(F.when(F.col(c) < found[c][k], 1)), F.count(F.when(F.col(c) <= found[c][k], 1))
            within = (low <= n * (p + RANK_ERROR)) & (high >= n * (p - RANK_ERROR))
            prob = F.lit(str(p)).cast("decimal(3,2)" if p != 0.5 else "decimal(2,1)").cast("decimal(3,2)")
            rows.append(F.struct(F.lit(c).alias("column_name"), prob.alias("prob"), n.alias("n"), within.alias("within")))
    return t.lineitem.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def _wide(columns: int) -> dict[str, str]:
    """Columns made of two of the table's, each with other gaps."""
    made = {}
    for k in range(columns):
        a, b = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")[k % 4], ("l_extendedprice", "l_discount", "l_quantity")[k % 3]
        made[f"w{k}"] = f"CASE WHEN l_orderkey % {k + 2} > 0 THEN {a} * {k + 1} + {b} * ((l_linenumber * {k + 3}) % 7) END"
    return made


WIDE = _wide(40)


@query(
    "WITH w AS (SELECT " + ", ".join(f"{text} AS {name}" for name, text in WIDE.items()) + " FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM w" for i, a in enumerate(WIDE) for b in list(WIDE)[:i])
)
def corr_wide(t: Tables) -> DataFrame:
    """Correlations of forty columns with gaps of their own: one scan, one matrix product per block of rows."""
    return profile.corr_matrix(t.lineitem.selectExpr(*(f"{text} AS {name}" for name, text in WIDE.items())))


@query("SELECT 'l_extendedprice' AS column_name, count(l_extendedprice) AS n, round(avg(l_extendedprice), 6) AS mean, true AS within FROM lineitem")
def summary_sketched(t: Tables) -> DataFrame:
    """The summary and the middle of a column by sketches: their quartiles lie between exact ones one percent of the ranks off."""
    column = "l_extendedprice"
    low, high = (quantiles.exact_quantiles(t.lineitem, [column], [p + side for p in PROBS])[column] for side in (-RANK_ERROR, RANK_ERROR))
    made = profile.summary_numeric(t.lineitem, [column], RANK_ERROR)
    within = F.lit(True)
    for name, a, b in zip(("q1", "median", "q3"), low, high):
        within = within & F.col(name).between(a, b)
    return made.select("column_name", "n", "mean", within.alias("within"))


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev({c}), 6) AS stddev, "
        f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM part"
        for c in ("p_partkey", "p_size", "p_retailprice")
    )
)
def describe_all_numeric(t: Tables) -> DataFrame:
    """Statistics of every numeric column of parts, found by its type."""
    return profile.describe_numeric(t.part)

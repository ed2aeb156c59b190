"""Aggregation before joins gives what joining rows first gives."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from goldseam.functions import fixed_point
from goldseam.operators import measures as ms
from goldseam.operators.aggregates import kpi
from goldseam.operators.joins import enrich


def measures():
    v = F.col("v")
    return {
        "n": ms.count_rows(), "known": ms.count_present(v), "large": ms.count_where(v > 5), "low": ms.least(v), "high": ms.greatest(v),
        "sum": ms.total(v), "mean": ms.mean(v, 4),
    }


@pytest.fixture
def fact(spark):
    # Half of all rows on one key, keys without a dimension row, NULL keys and values.
    rows = [(1 if k % 2 else k % 7, None if k % 11 == 0 else k % 5, None if k % 13 == 0 else k * 0.005 - 7, k % 3) for k in range(700)]
    return spark.createDataFrame(rows, "a int, b int, v double, m int")


@pytest.fixture
def dims(spark):
    # Key 2 of the first dimension stands twice: it repeats rows.
    first = spark.createDataFrame([(0, "x"), (1, "y"), (2, "x"), (2, "z"), (None, "w")], "k int, name string")
    second = spark.createDataFrame([("x", 10), ("y", 20)], "name string, grp int")
    third = spark.createDataFrame([(b, f"b{b % 2}") for b in range(5)], "b int, kind string")
    return [ms.Dimension(first, {"a": "k"}, ["name"]), ms.Dimension(second, {"name": "name"}, {"group": "grp"}), ms.Dimension(third, {"b": "b"}, ["kind"])]


def test_equal_to_joining_rows(fact, dims):
    keys = ["name", "group", "kind", "m"]
    joined = fact
    for d in dims:
        joined = enrich(joined, d.frame, d.on, d.bring)
    want = kpi(joined, keys, measures(), {"pct": ("large", "known")})
    got = kpi(fact, keys, measures(), {"pct": ("large", "known")}, dims)
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_no_row_of_the_fact_is_shuffled_for_a_join(spark, fact, dims):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = kpi(fact, ["name", "m"], {"sum": ms.total("v")}, dimensions=dims[:1])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    fact_side = plan[plan.index("Join") :].split("Scan")[0]
    # From the join down to the scan: aggregate, shuffle of groups, aggregate in the map tasks.
    assert fact_side.index("HashAggregate") < fact_side.rindex("Exchange") < fact_side.rindex("partial_sum")


def test_an_empty_fact(fact, dims):
    assert kpi(fact.limit(0), ["name"], measures(), dimensions=dims).collect() == []


def test_decimals_are_a_parameter(spark):
    tiny = spark.createDataFrame([(4e-11,)] * 1000, "x double")
    assert tiny.agg(fixed_point.exact_total("x")).first()[0] == 0
    assert tiny.agg(fixed_point.exact_total("x", 12)).first()[0] == Decimal("4e-8")
    assert tiny.where(fixed_point.finer_than("x")).count() == 1000 and tiny.where(fixed_point.finer_than("x", 12)).count() == 0
    assert tiny.agg(ms.total("x", 9, 12).of_rows()).first()[0] == 4e-8
    with pytest.raises(ValueError):
        fixed_point.limbs("x", 16)


def test_digits_of_all_sizes(spark):
    values = [0.1, -0.1, 1.005, 99999.99999, 100000.00001, 123456789.1234, 123456789012.123, 999999999999999.0, -(2.0**58), 0.00000000005, 0.00000000004, *(10.0**k for k in range(15)), *(-(10.0**k) - 1 / 16 for k in range(11))]
    df = spark.createDataFrame(list(enumerate(values)), "k int, x double")
    for row in df.groupBy("k", "x").agg(fixed_point.exact_total("x").alias("t")).collect():
        assert row.t == Decimal(repr(row.x)).quantize(Decimal("1e-10"), rounding="ROUND_HALF_UP") if abs(row.x) < 1e15 else int(row.x)

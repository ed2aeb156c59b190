"""Sketches that find hot keys and distinct values, centroids, and writes that are read back."""

import math

import pytest
from pyspark.sql import functions as F

from goldseam.operators import joins, scoring
from goldseam.operators.aggregates import distinct_from_sketches, distinct_sketches
from goldseam.sources import sinks


def test_hot_keys_by_sketch(spark):
    rows = [(7,)] * 500 + [(None,)] * 300 + [(k,) for k in range(100, 2_000)]
    df = spark.createDataFrame(rows, "`odd ``name` int").repartition(6)
    assert set(joins.hot_keys(df, "odd `name", 0.05, 10)) == {7, None}
    assert joins.hot_keys(df, "odd `name", 0.05, 1_000) == []
    assert joins.hot_keys(df.limit(0), "odd `name", 0.05, 1) == []
    plan = df.agg(F.expr("approx_top_k(`odd ``name`, 10, 100)"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_hot_keys_with_a_side_that_repeats_them(spark, monkeypatch):
    fact = spark.createDataFrame([(k % 3, k) for k in range(60)], "k int, v int")
    dim = spark.createDataFrame([(0, f"a{j}") for j in range(9)] + [(1, "b")], "k int, name string")
    want = sorted(map(tuple, joins.enrich(fact, dim, {"k": "k"}, ["name"]).collect()), key=str)
    for few in (100, 5):
        monkeypatch.setattr(joins, "FEW_ROWS", few)
        assert sorted(map(tuple, joins.enrich(fact, dim, {"k": "k"}, ["name"], hot=[0, 2]).collect()), key=str) == want


def test_distinct_values_roll_up(spark):
    df = spark.createDataFrame([(k % 7, k % 2, k % 900 if k % 5 else None) for k in range(9_000)], "day int, g int, user int")
    daily = distinct_sketches(df, ["day", "g"], "user")
    exact = {r.g: r.n for r in df.groupBy("g").agg(F.count_distinct("user").alias("n")).collect()}
    for r in distinct_from_sketches(daily, ["g"]).collect():
        assert abs(r.n - exact[r.g]) <= 0.05 * exact[r.g]
    assert distinct_from_sketches(distinct_sketches(df.limit(0), ["day"], "user"), ["day"]).collect() == []


def test_centroids(spark):
    nan = float("nan")
    rows = [("a", [1.0, 2.0]), ("a", [3.0, 2.0]), ("b", [10.0, 0.0]), (None, [1.0, 1.0]), ("b", None), ("b", [nan, 1.0]), ("b", [None, 1.0]), ("b", [math.inf, 1.0])]
    df = spark.createDataFrame(rows, "l string, f array<double>")
    model = scoring.class_centroids(df, "f", "l")
    assert sorted(tuple(r) for r in model.collect()) == [("a", 2, [2.0, 2.0], 1.0), ("b", 1, [10.0, 0.0], 0.0)]
    given = spark.createDataFrame([(1, [2.0, 3.0]), (2, [9.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [6.0, 1.0])], "k int, f array<double>")
    found = {r.k: (r.predicted, r.margin) for r in scoring.nearest_centroid(given, model, "f").collect()}
    assert found[1][0] == "a" and found[2][0] == "b" and found[3] == found[4] == (None, None)
    assert found[1][1] == pytest.approx(72.0) and found[5] == ("a", 0.0)
    one = scoring.nearest_centroid(given, model.where("l = 'b'" if "l" in model.columns else "label = 'b'"), "f")
    assert {(r.predicted, r.margin) for r in one.where("k < 3").collect()} == {("b", None)}
    with pytest.raises(ValueError):
        before, scoring.MOST_CLASSES = scoring.MOST_CLASSES, 1
        try:
            scoring.nearest_centroid(given, model, "f")
        finally:
            scoring.MOST_CLASSES = before


def test_checksums_tell_rows_apart(spark):
    df = spark.createDataFrame([(1, {"a": 1.0, "b": 2.0}, None), (1, {"b": 2.0, "a": 1.0}, None), (None, None, None)], "k int, m map<string,double>, s string")

    def checksum(df):
        return df.agg(sinks.row_checksum(df)).first()[0]

    assert checksum(df) == checksum(df.repartition(3)) and checksum(df.limit(0)) == 0
    assert len({checksum(d) for d in (df, df.limit(2), df.unionByName(df), df.withColumn("s", F.lit("x")), df.where("k IS NULL"))}) == 5


def test_a_write_is_read_back(spark, tmp_path):
    df = spark.createDataFrame([(k, k % 3) for k in range(100)], "k int, p int")
    assert sinks.write_layer(df, "layers.read_back", "parquet", ["p"], verify=True) == 100
    row = sinks.write_verified(df, str(tmp_path / "out")).first()
    assert tuple(row) == (100, 100, True)
    good = df.agg(sinks.row_checksum(df)).first()[0]
    sinks.verify_write(spark, "layers.read_back", 100, good, df.columns)
    changed = df.withColumn("p", F.when(F.col("k") == 5, 0).otherwise(F.col("p")))
    sinks.write_layer(changed, "layers.read_back")
    with pytest.raises(ValueError, match="not those written"):
        sinks.verify_write(spark, "layers.read_back", 100, good, df.columns)


def test_quantiles_of_sketches(spark):
    from goldseam.operators import profile, quantiles

    df = spark.createDataFrame([(k % 9, float(k % 1000) if k % 10 else None, float("nan")) for k in range(20_000)], "day int, v double, w double")
    daily = quantiles.quantile_sketches(df, ["day"], ["v", "w"], 0.01)
    row = quantiles.quantiles_from_sketches(daily, [], ["v", "w"], [0.0, 0.5, 1.0]).first()
    assert abs(row.v[1] - 500) <= 12 and row.v[0] == 1.0 and row.v[2] == 999.0 and row.w is None
    one = profile.summary_numeric(df, ["v", "day"], rel_error=0.01)
    assert abs({r.column_name: r for r in one.collect()}["v"].median - 500) <= 12
    assert profile.summary_numeric(df.limit(0), ["v"], rel_error=0.01).first().median is None
    assert profile.iqr_bounds(df.limit(0), "v", rel_error=0.01) is None and abs(profile.iqr_bounds(df, "v", rel_error=0.01)["q1"] - 250) <= 12
    with pytest.raises(ValueError):
        quantiles.sketch_size(1e-6)


def test_wide_correlation_is_the_pairwise_one(spark):
    from goldseam.operators import profile

    rows = [(float(k), 1e9 + k * k, None if k % 3 else float(-k), 5.0, float("nan") if k == 7 else float(k), None) for k in range(50)]
    df = spark.createDataFrame(rows, "a double, `b ``x` double, c double, d double, e double, f double").repartition(3)
    got, want = (
        {(r.col_a, r.col_b): str(r.r) for r in profile.corr_matrix(df.toDF("a", "b", "c", "d", "e", "f"), pairs_in_sql=most).collect()} for most in (0, 200)
    )
    assert got == want
    assert profile.wide_correlation(df, df.columns).count() == 15

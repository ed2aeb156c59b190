from datetime import date

import pytest
from pyspark.sql import functions as F

from goldseam.operators import shaping


def test_conform_turns_malformed_text_into_null(frame):
    df = frame([("1", "2020-01-02", "3.5", "x"), ("a", "soon", "", "y")], "i STRING, d STRING, f STRING, keep STRING")
    out = shaping.conform(df, {"i": "int", "d": "date", "f": "double"}, stamp="ingestion_time")
    assert out.columns == ["i", "d", "f", "keep", "ingestion_time"]
    assert [tuple(r)[:4] for r in out.collect()] == [(1, date(2020, 1, 2), 3.5, "x"), (None, None, None, "y")]
    assert dict(out.dtypes)["ingestion_time"] == "timestamp"


def test_present_columns(frame):
    df = frame([(1, 2, 3)], "a INT, b INT, c INT")
    assert shaping.keep_present(df, ["c", "missing", "a"]).columns == ["c", "a"]
    assert shaping.drop_present(df, ["b", "missing"]).columns == ["a", "c"]
    assert shaping.other_columns(df, ["b"]) == ["a", "c"]


def test_typed_projection(frame):
    out = shaping.typed_projection(frame([(1, "2")], "a INT, b STRING"), {"x": (F.col("b"), "int"), "y": (F.lit(None), "string")})
    assert out.dtypes == [("x", "int"), ("y", "string")]
    assert out.first() == (2, None)


def test_valid_range_includes_bounds_and_drops_null(frame, values):
    df = frame([(90.0,), (-90.0,), (90.01,), (-90.01,), (None,), (0.0,)], "lat DOUBLE")
    assert values(shaping.valid_range(df, {"lat": (-90, 90)})) == [(-90.0,), (0.0,), (90.0,)]
    assert values(shaping.valid_range(df, {"lat": (0, None)})) == [(0.0,), (90.0,), (90.01,)]


def test_order_blank_and_equality_filters(frame, values):
    df = frame([(1, 2, "a"), (2, 2, " "), (3, 2, "b"), (None, 2, "c")], "a INT, b INT, t STRING")
    assert values(shaping.in_order(df, "a", "b").select("a")) == [(1,), (2,)]
    assert values(shaping.not_blank(df, ["t"]).select("t")) == [("a",), ("b",), ("c",)]
    assert shaping.filter_by(df, b=2, t="All").count() == 4
    assert shaping.filter_by(df, b=2, t="a").count() == 1


def test_dedupe_is_deterministic_and_keeps_one_null_key(frame, values):
    rows = [(1, "b", 1.0), (1, "c", 0.5), (1, "a", 9.0), (None, "x", 1.0), (None, "y", 1.0), (2, "z", None)]
    expected = [(None, "y", 1.0), (1, "a", 9.0), (2, "z", None)]
    for order in (rows, rows[::-1]):
        df = frame(order, "k INT, name STRING, v DOUBLE").repartition(3)
        assert values(shaping.dedupe(df, ["k"], [F.desc_nulls_last("v")])) == expected


def test_dedupe_trims_hot_keys_before_the_shuffle(spark, plan):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    kept = shaping.dedupe(df, ["k"])
    text = plan(kept)
    assert "Partial" in text[text.index("Exchange") :]
    assert kept.count() == df.select("k").distinct().count()
    assert kept.filter("k = 0").first()["id"] == 8997


def test_dedupe_with_map_column(frame):
    df = frame([(1, {"a": 1}, 1), (1, {"b": 1}, 2)], "k INT, m MAP<STRING, INT>, v INT")
    assert shaping.dedupe(df, ["k"]).collect() == [(1, {"b": 1}, 2)]


@pytest.mark.parametrize("n", [0, 2])
def test_sample_rows(frame, n):
    df = frame([(3, "c"), (1, "a"), (2, "b")], "k INT, t STRING")
    assert [r["t"] for r in shaping.sample_rows(df, ["t"], [F.asc("k")], n).collect()] == ["a", "b", "c"][:n]


def test_nan_and_infinity_become_null_and_fail_ranges(frame, values):
    odd = [(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (2.0,)]
    df = frame(odd, "x DOUBLE")
    assert values(shaping.conform(df, {"x": "double"})) == [(None,)] * 4 + [(2.0,)]
    assert values(shaping.conform(frame([("NaN",), ("1.5",)], "x STRING"), {"x": "double"})) == [(None,), (1.5,)]
    assert values(shaping.valid_range(df, {"x": (0, None)})) == [(2.0,)]
    assert values(shaping.valid_range(df, {"x": (None, 3)})) == [(2.0,)]


def test_dedupe_tells_rows_apart_by_maps(frame):
    rows = [(1, {"a": 1, "b": 2}), (1, {"a": 3})]
    found = [shaping.dedupe(frame(r, "k INT, m MAP<STRING, INT>"), ["k"]).first().m for r in (rows, rows[::-1])]
    assert found[0] == found[1]

import math
import random
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from goldseam.functions import dates, fixed_point, scores, text
from goldseam.functions.sql_functions import register_threshold


def half_up(number: Decimal, digits: int) -> float:
    return float(number.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def test_exact_mean_and_sum_match_decimals(frame):
    rng = random.Random(5)
    groups = {g: [rng.randint(-3000, 9000) for _ in range(rng.randint(1, 9))] for g in range(200)}
    groups[200] = [1, 2]  # mean 0.015: a tie, away from zero
    groups[201] = [-1, -2]
    df = frame([(g, c / 100) for g, cents in groups.items() for c in cents], "g INT, x DOUBLE")
    out = df.groupBy("g").agg(
        fixed_point.exact_mean("x").alias("m"),
        fixed_point.exact_mean("x", 4).alias("m4"),
        fixed_point.exact_sum("x").alias("s"),
    )
    for g, m, m4, s in out.collect():
        total = Decimal(sum(groups[g])) / 100
        assert m == half_up(total / len(groups[g]), 2)
        assert m4 == half_up(total / len(groups[g]), 4)
        assert s == float(total)
    assert dict(out.select("g", "m").filter("g >= 200").collect()) == {200: 0.02, 201: -0.02}


def test_exact_mean_of_missing_values_and_nan(frame):
    df = frame([(None,), (2.0,)], "x DOUBLE")
    assert df.agg(fixed_point.exact_mean("x")).first()[0] == 2.0
    assert df.filter("x IS NULL").agg(fixed_point.exact_mean("x")).first()[0] is None
    with pytest.raises(Exception, match="NaN"):
        frame([(float("nan"),)], "x DOUBLE").agg(fixed_point.exact_sum("x")).first()


def test_percent_rounds_half_up_and_survives_zero(spark):
    def pct(a, b):
        return spark.range(1).select(fixed_point.percent(F.lit(a), F.lit(b))).first()[0]

    assert pct(1, 3) == 33.33
    assert pct(2, 3) == 66.67
    assert pct(1, 32) == 3.13  # 3.125
    assert pct(0, 0) is None
    assert pct(5, 5) == 100.0


def test_totals_near_the_limit_of_bigint(frame):
    df = frame([("a", 4.0e16), ("b", 4.0e16), ("b", 1.0e16)], "g STRING, x DOUBLE")
    out = df.groupBy("g").agg(fixed_point.exact_sum("x"), fixed_point.exact_mean("x"))
    assert sorted(map(tuple, out.collect())) == [("a", 4.0e16, 4.0e16), ("b", 5.0e16, 2.5e16)]
    many = frame([(3.0e15,)] * 20, "x DOUBLE").agg(fixed_point.exact_mean("x", 3))
    assert many.first()[0] == 3.0e15
    units = F.lit(4 * 10**18)
    assert df.select(fixed_point.percent(units, units * 2, kind=fixed_point.WIDE)).first()[0] == 50.0
    twice = df.unionByName(df).agg(fixed_point.exact_sum("x"))
    assert twice.first()[0] == 1.8e17


def test_no_row_is_rounded_before_it_is_added(frame):
    small = frame([(0.004,)] * 1000, "x DOUBLE").agg(fixed_point.exact_sum("x"), fixed_point.exact_mean("x", 3))
    assert tuple(small.first()) == (4.0, 0.004)
    assert frame([(5.0e16,)] * 2, "x DOUBLE").agg(fixed_point.exact_sum("x")).first()[0] == 1.0e17
    flags = frame([(0.125,), (1e-11,), (None,)], "x DOUBLE").select(fixed_point.finer_than("x"))
    assert [r[0] for r in flags.collect()] == [False, True, None]
    for bad in (float("nan"), float("inf"), float("-inf")):
        with pytest.raises(Exception, match="NaN and infinity"):
            frame([(bad,)], "x DOUBLE").agg(fixed_point.exact_sum("x")).first()



def test_parse_dates_tries_formats_in_order(frame):
    given = ["02/03/2020", "25/12/2020", "2020-12-25", "25-12-2020", "2020/12/25", "bad", "31/31/2020", None]
    df = frame([(t,) for t in given], "t STRING")
    christmas = date(2020, 12, 25)
    assert [r[0] for r in df.select(dates.parse_dates("t")).collect()] == [
        date(2020, 2, 3), christmas, christmas, christmas, christmas, None, None, None,
    ]


def test_the_quick_look_at_a_date_never_rejects_what_parses(frame):
    rng = random.Random(9)
    formats = dates.BIRTH_DATE_FORMATS
    given = [
        rng.choice(["{0}/{1}/{2}", "{2}-{1}-{0}", "{0}-{1}-{2}", "{2}/{1}/{0}", "{0}{1}{2}", "{0}/{1}-{2}"]).format(
            rng.choice(["01", "12", "13", "31", "32", "5", "00"]),
            rng.choice(["01", "02", "12", "13", "31", "7"]),
            rng.choice(["1999", "2020", "20", "02020", "+12020", "202"]),
        )
        for _ in range(400)
    ]
    df = frame([(t,) for t in given], "t STRING")
    for fmt in formats:
        plain = F.try_to_timestamp("t", F.lit(fmt)).cast("date")
        rows = df.select("t", plain.alias("a"), dates.parse_dates("t", [fmt]).alias("b"))
        assert rows.filter(~F.col("a").eqNullSafe(F.col("b"))).select("t").collect() == []
    assert df.filter(dates.parse_dates("t").isNotNull()).count() > 30


def test_month_buckets(frame):
    df = frame([(date(2021, 3, 9),), (None,)], "d DATE")
    assert [tuple(r) for r in df.select(dates.month_label("d"), dates.month_start("d")).collect()] == [
        ("2021-03", date(2021, 3, 1)), (None, None),
    ]


def test_names_and_addresses(frame):
    df = frame([("Doe, Jane",), ("Solo",), ("",), ("  ",), (None,)], "n STRING")
    assert [tuple(r) for r in df.select(text.name_part("n", 0), text.name_part("n", 1), text.is_blank("n")).collect()] == [
        ("Doe", "Jane", False), ("Solo", None, False), ("", None, True), ("", None, True), (None, None, True),
    ]
    places = frame([("Queens", "Astoria", 11102), (None, None, None)], "a STRING, b STRING, c INT")
    assert [r[0] for r in places.select(text.joined_address("a", "b", "c")).collect()] == ["Queens, Astoria, 11102", ", , "]


def test_name_separator_is_plain_text(frame):
    assert frame([("a.b",)], "n STRING").select(text.name_part("n", 1, ".")).first()[0] == "b"


def test_paths(frame):
    df = frame([("dbfs:/x/dent_12.JPG",), ("plain",), ("folder/",), (None,)], "p STRING")
    leaf = text.path_leaf("p")
    assert [tuple(r) for r in df.select(leaf, text.leading_token(leaf), text.file_extension(leaf)).collect()] == [
        ("dent_12.JPG", "dent", "jpg"), ("plain", "plain", ""), ("", "", ""), (None, None, None),
    ]


def test_confidence_tiers_at_the_bounds(frame):
    df = frame([(0.8,), (0.7999,), (0.5,), (0.4999,), (None,)], "s DOUBLE")
    assert [r[0] for r in df.select(scores.confidence_tier("s")).collect()] == ["alta", "media", "media", "baja", "baja"]


def test_softmax_argmax_and_top(frame):
    logits = [2.0, -1.0, 2.0, 900.0, 899.0]
    df = frame([(logits,)], "v ARRAY<DOUBLE>")
    row = df.select(scores.softmax("v"), scores.argmax("v"), scores.top_positions("v", 3)).first()
    e = math.exp(-1)
    assert row[0] == pytest.approx([0.0, 0.0, 0.0, 1 / (1 + e), e / (1 + e)])
    assert row[1] == 3
    assert row[2] == [3, 4, 0]  # positions 0 and 2 tie: the first comes first


def test_top_k_of_a_map(frame):
    df = frame([({"a": 0.2, "b": 0.5, "c": 0.2, "d": 0.1},)], "m MAP<STRING, DOUBLE>")
    assert [tuple(e) for e in df.select(scores.top_k("m", 3)).first()[0]] == [("b", 0.5), ("a", 0.2), ("c", 0.2)]


def test_sql_threshold_is_inlined_into_the_scan(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    spark.createDataFrame([(10.0,), (12.0,), (12.5,), (None,)], "x DOUBLE").write.parquet(path)
    name = register_threshold(spark, "above_twelve", 12.0)
    df = spark.read.parquet(path).filter(F.expr(f"{name}(x)"))
    assert [r[0] for r in df.collect()] == [12.5]
    assert "GreaterThan(x,12.0)" in plan(df)

from decimal import Decimal
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from goldseam.operators import profile
from goldseam.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def discrete(ordered, p):
    return ordered[max(0, math.ceil(p * len(ordered)) - 1)]


def continuous(ordered, p):
    at = p * (len(ordered) - 1)
    low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
    return low + (high - low) * (at - math.floor(at))


def samples():
    rng = random.Random(3)
    yield [1.0]
    yield [2.0, 1.0]
    yield [5.0] * 50
    yield [rng.expovariate(1) for _ in range(700)]
    yield [rng.choice([0.0, 1.0]) for _ in range(301)]
    yield [0.0] * 300 + [rng.random() for _ in range(600)]
    yield [float(rng.randint(-5, 5)) for _ in range(200)] + [1e12]


@pytest.mark.parametrize("few", [100_000, 3])
@pytest.mark.parametrize("data", list(samples()), ids=lambda d: str(len(d)))
def test_quantiles_are_exact(frame, data, few):
    noise = [(None,), (float("nan"),)]
    df = frame([(x,) for x in data] + noise, "x DOUBLE").repartition(3)
    ordered = sorted(data)
    assert exact_quantiles(df, ["x"], PROBS, few=few)["x"] == [discrete(ordered, p) for p in PROBS]
    found = exact_quantiles(df, ["x"], PROBS, continuous=True, few=few)["x"]
    assert found == pytest.approx([continuous(ordered, p) for p in PROBS])


def test_quantiles_of_several_columns_and_of_nothing(frame):
    df = frame([(i, None, float(-i)) for i in range(100)], "a INT, b DOUBLE, c DOUBLE")
    assert exact_quantiles(df, ["a", "b", "c"], [0.5]) == {"a": [49.0], "b": [None], "c": [-50.0]}


def test_shape_and_nulls(frame, values):
    df = frame([(1, float("nan"), None), (None, 1.0, "x"), (2, None, "y")], "i INT, f DOUBLE, s STRING")
    assert values(profile.profile_shape(df)) == [("f", "double", 3, 3), ("i", "int", 3, 3), ("s", "string", 3, 3)]
    assert values(profile.null_profile(df)) == [("f", 1, 1, 3), ("i", 1, 0, 3), ("s", 1, 0, 3)]


def test_summary(frame):
    xs = [4, 1, 3, 2, None]
    df = frame([(x, "t") for x in xs], "x INT, t STRING")
    assert [tuple(r) for r in profile.describe_numeric(df).collect()] == [("x", 4, 2.5, 1.290994, 1.0, 4.0)]
    assert [tuple(r) for r in profile.summary_numeric(df).collect()] == [("x", 4, 2.5, 1.290994, 1.0, 1.0, 2.0, 3.0, 4.0)]


def test_describe_text(frame):
    df = frame([("b", 1), ("a", 2), (None, 3)], "t STRING, k INT")
    assert [tuple(r) for r in profile.describe_text(df).collect()] == [("t", 2, "a", "b")]


def test_correlation_is_pairwise_complete(frame):
    df = frame([(1.0, 2.0, 5.0), (2.0, 4.0, None), (3.0, 6.0, 1.0), (4.0, None, 0.0)], "a DOUBLE, b DOUBLE, c DOUBLE")
    r = {(x["col_a"], x["col_b"]): x["r"] for x in profile.corr_matrix(df).collect()}
    assert profile.corr_matrix(df, pairs_in_sql=2).count() == 3
    assert r["b", "a"] == 1.0 and set(r) == {("b", "a"), ("c", "a"), ("c", "b")}
    assert r["c", "a"] == pytest.approx(statistics.correlation([1, 3, 4], [5, 1, 0]), abs=1e-6)


def test_iqr_outliers(frame, values):
    df = frame([(float(x),) for x in [1, 2, 3, 4, 5, 6, 7, 8, 100, -90]] + [(None,)], "x DOUBLE")
    assert profile.iqr_bounds(df, "x") == {"q1": 2.0, "q3": 7.0, "low": -5.5, "high": 14.5}
    assert values(profile.iqr_outliers(df, "x")) == [(-90.0,), (100.0,)]
    assert values(profile.iqr_outliers(df, "x", rel_error=0.05)) == [(-90.0,), (100.0,)]
    assert profile.iqr_outliers(df.filter("x IS NULL"), "x").count() == 0


def test_zscore_guards_constant_columns(frame):
    df = frame([(1.0,), (1.0,)], "x DOUBLE")
    assert [r["zscore"] for r in profile.with_zscore(df, "x").collect()] == [None, None]
    assert profile.zscore_outliers(df, "x").count() == 0
    spread = frame([(0.0,)] * 20 + [(100.0,)], "x DOUBLE")
    assert [r["x"] for r in profile.zscore_outliers(spread, "x").collect()] == [100.0]


def test_histogram_lists_all_bins_and_counts_every_row(frame):
    rng = random.Random(1)
    xs = [rng.gauss(0, 5) for _ in range(500)]
    df = frame([(x,) for x in xs] + [(None,)], "x DOUBLE")
    rows = profile.histogram(df, "x", 20).orderBy("bin").collect()
    assert [r["bin"] for r in rows] == list(range(20))
    assert sum(r["n"] for r in rows) == 500
    assert rows[0]["bin_from"] == min(xs) and rows[-1]["bin_to"] == pytest.approx(max(xs))
    flat = profile.histogram(frame([(7.0,)] * 5, "x DOUBLE"), "x", 20).filter("n > 0").collect()
    assert [(r["bin"], r["n"]) for r in flat] == [(10, 5)]


def test_grid_counts(frame, values):
    df = frame([(0.1, 10.0), (0.2, 12.0), (0.9, 99.0), (None, 1.0), (0.3, None)], "x DOUBLE, y DOUBLE")
    assert values(profile.grid_counts(df, "x", "y", 0.5, 50.0)) == [(0, 0, 2), (1, 1, 1)]


def test_statistics_do_not_collect_rows_or_cross_join(frame, plan):
    df = frame([(1.0,), (2.0,)], "x DOUBLE").groupBy("x").agg(F.count("*").alias("n"))
    for out in (profile.zscore_outliers(df, "n"), profile.histogram(df, "n")):
        text = plan(out)
        assert "Cartesian" not in text and "NestedLoop" not in text


def test_histogram_leaves_nan_out(frame):
    df = frame([(float("nan"),), (float("inf"),), (0.0,), (1.0,)], "x DOUBLE")
    assert [(r.bin_from, r.bin_to, r.n) for r in profile.histogram(df, "x", 2).orderBy("bin").collect()] == [(0.0, 0.5, 1), (0.5, 1.0, 1)]


def test_quartiles_keep_decimals_and_large_numbers(frame):
    money = frame([(Decimal(f"{k}.10"),) for k in range(1, 9)], "x DECIMAL(12,2)")
    assert exact_quantiles(money, ["x"], (0.25, 0.5), continuous=True)["x"] == [Decimal("2.85"), Decimal("4.60")]
    assert profile.iqr_outliers(money.union(frame([(Decimal("99.10"),)], "x DECIMAL(12,2)")), "x").count() == 1
    large = frame([(2**53 + 1,), (2**53 + 3,)], "x BIGINT")
    assert exact_quantiles(large, ["x"], (0.25,))["x"] == [2**53 + 1]

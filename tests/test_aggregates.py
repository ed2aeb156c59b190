import pytest
from pyspark.sql import functions as F

from goldseam.operators import aggregates as agg


@pytest.fixture
def flights(frame):
    return frame(
        [("A", "ok", 10.0), ("A", "late", 20.01), ("A", None, None), ("B", "late", 5.0), (None, "ok", 1.0)],
        "g STRING, state STRING, x DOUBLE",
    )


def test_kpi(flights, values):
    out = agg.kpi(
        flights,
        ["g"],
        {"n": agg.rows(), "states": agg.present("state"), "ok": agg.count_where(F.col("state") == "ok"),
         "mean_x": agg.mean("x", 2, exact=True), "sum_x": agg.total("x")},
        {"ok_pct": ("ok", "states")},
    )
    assert values(out) == [(None, 1, 1, 1, 1.0, 1.0, 100.0), ("A", 3, 2, 1, 15.01, 30.01, 50.0), ("B", 1, 1, 0, 5.0, 5.0, 0.0)]


def test_kpi_percentage_of_nothing_is_null(frame):
    out = agg.kpi(frame([(1, None)], "g INT, k INT"), ["g"], {"n": agg.present("k")}, {"pct": ("n", "n")})
    assert out.first() == (1, 0, None)


def test_class_distribution(frame, values):
    df = frame([("a",)] * 96 + [("b",)] * 4, "label STRING")
    assert values(agg.class_distribution(df, "label")) == [("a", 96, 96.0, False, 4.0), ("b", 4, 4.0, True, 4.0)]


def test_best_by_ignores_rows_without_value_and_breaks_ties(frame, values):
    rows = [(1, "x", 0.9, "i1"), (1, "y", 0.9, "i2"), (1, None, 0.99, "i3"), (2, None, 0.5, "i4"), (3, "z", None, "i5")]
    for order in (rows, rows[::-1]):
        df = frame(order, "k INT, label STRING, score DOUBLE, img STRING").repartition(3)
        out = agg.best_by(df, ["k"], "label", "score", ["img"], {"top": F.max("score"), "n": agg.rows()})
        assert values(out) == [(1, "y", 0.99, 3), (2, None, 0.5, 1), (3, "z", None, 1)]


def test_distinct_list(frame):
    df = frame([("b",), ("a",), ("b",), (None,)], "t STRING")
    assert df.agg(agg.distinct_list("t")).first()[0] == "a,b"


def test_top_groups_has_a_total_order(frame):
    df = frame([("a", 1.0), ("b", 3.0), ("c", 3.0), (None, 99.0), ("d", 0.5)], "k STRING, v DOUBLE")
    out = agg.top_groups(df, "k", agg.total("v"), 3)
    assert [tuple(r) for r in out.collect()] == [("b", 3.0), ("c", 3.0), ("a", 1.0)]


def test_listed_categories_are_always_there(frame):
    df = frame([("x", 1.5), ("x", 2.5), ("z", 1.0), (None, 7.0)], "c STRING, v DOUBLE")
    assert [tuple(r) for r in agg.counts_with_categories(df, "c", ["y", "x"]).collect()] == [(0, "y", 0), (1, "x", 2)]
    out = agg.measures_with_categories(df, "c", ["y", "x"], F.col("v"))
    assert [tuple(r) for r in out.collect()] == [(0, "y", None, None), (1, "x", 2.0, 4.0)]
    assert [r[2] for r in agg.counts_with_categories(df.limit(0), "c", ["y", "x"]).collect()] == [0, 0]


def test_cross_counts_fill_with_zero(frame, values):
    df = frame([("a", "P"), ("a", "P"), ("b", "Q")], "r STRING, c STRING")
    out = agg.cross_counts(df, "r", "c", ["P", "Q", "R"])
    assert out.columns == ["r", "P", "Q", "R"]
    assert values(out) == [("a", 2, 0, 0), ("b", 0, 1, 0)]


def test_best_row_gives_all_its_columns(frame, values):
    rows = [("c", None, 0.9, "alta"), ("c", "dent", 0.4, "baja"), ("d", None, 0.7, "media")]
    df = frame(rows, "k STRING, label STRING, score DOUBLE, level STRING")
    best = agg.best_by(df, ["k"], "label", "score", [], {"n": F.count("*")}, {"score": F.col("score"), "level": F.col("level")})
    assert values(best.select("k", "label", "score", "level", "n")) == [("c", "dent", 0.4, "baja", 2), ("d", None, None, None, 1)]


def test_cross_counts_keep_a_null_row(frame, values):
    df = frame([(None, "a"), (0, "b"), (0, "b")], "k INT, v STRING")
    assert values(agg.cross_counts(df, "k", "v", ["a", "b"])) == [(None, 1, 0), (0, 0, 2)]

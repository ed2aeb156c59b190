import pytest
from pyspark.sql import functions as F

from goldseam.operators import quality


@pytest.fixture
def df(frame):
    return frame([(1, "a", -1.0), (None, "", 2.0), (3, None, None), (3, "d", 5.0)], "k INT, t STRING, v DOUBLE")


def report_of(df):
    return quality.quality_report(
        df, {"no_key": F.col("k").isNull(), "no_text": F.col("t").isNull() | (F.col("t") == ""), "negative": F.col("v") < 0}
    )


def test_report_and_gates(df, values):
    report = report_of(df)
    assert values(report) == [("negative", 1, 4, 25.0), ("no_key", 1, 4, 25.0), ("no_text", 2, 4, 50.0)]
    quality.assert_quality(report, 2)
    with pytest.raises(ValueError, match="no_text: 2 rows"):
        quality.assert_quality(report, 1)
    assert not quality.is_ready(report)


def test_readiness(df):
    assert quality.is_ready(report_of(df.filter("k = 3 AND t = 'd'")))
    empty = report_of(df.limit(0))
    assert [r["failed_pct"] for r in empty.collect()] == [None, None, None]
    assert not quality.is_ready(empty)


def test_report_reads_the_data_once(df, plan):
    assert plan(report_of(df)).count("Exchange") == 1


def test_keys_ranges_coverage(df, values):
    assert quality.key_report(df, ["k"]).first() == (4, 1, 1, 1)
    assert quality.key_report(df.limit(0), ["k"]).first() == (0, 0, 0, 0)
    assert values(quality.value_ranges(df, ["k", "v"])) == [("k", 1.0, 3.0), ("v", -1.0, 5.0)]
    assert values(quality.key_coverage(df, ["k", "t"])) == [("k", 3, 1, 75.0), ("t", 3, 1, 75.0)]


def test_negative_zero_is_shown_as_zero(frame):
    ranges = quality.value_ranges(frame([(-0.0,), (0.0,)], "v DOUBLE"), ["v"]).first()
    assert str(ranges["min_value"]) == str(ranges["max_value"]) == "0.0"


def test_schema_gates(df):
    assert quality.require_columns(df, ["k"]) is df
    with pytest.raises(ValueError, match="missing columns: path, label"):
        quality.require_columns(df, ["path", "k", "label"])
    assert quality.type_mismatches(df, {"k": "int", "t": "date", "gone": "int"}) == [("t", "date", "string"), ("gone", "int", None)]
    with pytest.raises(ValueError):
        quality.require_rows(df.limit(0))
    quality.require_rows(df)


def test_missing_content(frame):
    df = frame([("b", None), ("a", None), ("c", bytearray(b"x"))], "path STRING, content BINARY")
    assert [r["path"] for r in quality.missing_content(df, ["path"]).collect()] == ["a", "b"]

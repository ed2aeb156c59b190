import pytest
from pyspark.sql import functions as F

from goldseam.operators import joins


@pytest.fixture
def fact(frame):
    return frame([(1, "a"), (1, "b"), (2, "c"), (9, "d"), (None, "e")], "k INT, t STRING")


@pytest.fixture
def dim(frame):
    return frame([(1, "one"), (2, "two"), (3, "three")], "k INT, name STRING")


LEFT = [(None, "e", None), (1, "a", "one"), (1, "b", "one"), (2, "c", "two"), (9, "d", None)]


def test_enrich_left_and_inner(fact, dim, values):
    assert values(joins.enrich(fact, dim, {"k": "k"}, ["name"])) == LEFT
    assert values(joins.enrich(fact, dim, {"k": "k"}, {"label": "name"}, "inner")) == [r for r in LEFT if r[2]]


def test_enrich_with_itself(fact, values):
    parents = joins.enrich(fact, fact, {"k": "k"}, {"other": "t"}, "inner")
    assert values(parents.filter("k = 2")) == [(2, "c", "c")]
    assert parents.count() == 2 * 2 + 1 + 1


@pytest.mark.parametrize("hot", [[1], [None], [1, None], [77], [1, 2, 9, None]])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_keys_change_nothing_in_the_result(fact, dim, values, hot, how):
    plain = values(joins.enrich(fact, dim, {"k": "k"}, ["name"], how))
    assert values(joins.enrich(fact, dim, {"k": "k"}, ["name"], how, hot)) == plain
    orphans = values(joins.orphans(fact, dim, "k"))
    assert orphans == [(None, "e"), (9, "d")]
    assert values(joins.orphans(fact, dim, "k", hot)) == orphans


def test_hot_rows_are_not_shuffled(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
        sums = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.count("*").alias("n"))
        text = plan(joins.enrich(fact, sums, {"k": "k"}, ["n"], hot=[3]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("BroadcastHashJoin") == 1 and text.count("SortMergeJoin") == 1


def test_find_hot_keys(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("k")
    )
    assert sorted(joins.hot_keys(df, "k", share=0.01, min_rows=1), key=str) == [0, None]
    assert joins.hot_keys(df, "k") == []
    assert joins.hot_keys(df.limit(0), "k") == []


def test_coverage_counts_rows_not_keys(fact, dim, frame):
    doubled = dim.unionByName(dim)
    assert joins.join_coverage(fact, doubled, ["k"]).first() == (5, 3, 2, 60.0)
    assert joins.join_coverage(fact.limit(0), dim, ["k"]).first() == (0, 0, 0, None)


def test_duplicates_and_fan_out(fact, dim, values):
    assert values(joins.duplicate_keys(fact, ["k"])) == [(1, 2)]
    widened = dim.join(fact, "k", "left")
    assert joins.fan_out(dim, widened).first() == (3, 4, 1)


def test_adaptive_execution_splits_a_hot_key(spark, tmp_path, plan):
    """A third of the rows on one key, both sides plain shuffles: the partition is split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
        spark.range(0, 30000, 1, 8).select(key.alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("x")).write.parquet(str(tmp_path / "f"))
        spark.range(30000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).write.parquet(str(tmp_path / "d"))
        out = joins.enrich(spark.read.parquet(str(tmp_path / "f")), spark.read.parquet(str(tmp_path / "d")), {"k": "k"}, ["v"])
        assert "skew=true" in plan(out, run=True)
        assert out.filter("k = 0").count() == 10000
        assert out.count() == 30000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

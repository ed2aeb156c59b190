"""Every bound query against its SQL, and what its plan must not contain."""

import pytest
from oracle import connect, differences

import __spark_entry__
from goldseam.plans.bound import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, con, name):
    assert differences(spark, con, name, QUERIES[name], ORACLES[name], FOLDER) == []


def test_entry(spark):
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracles) <= set(queries)
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries) and set(ORACLES) <= set(oracles)
    assert __spark_entry__.entry(spark).count() > 0
    assert QUERIES["train_classifier"](spark, FOLDER).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, plan, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES[name](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # A dimension written in the program, and rows of hot keys that were counted first.
    if name not in ("inline_dim", "enrich_hot_keys", "orphans_hot_keys"):
        assert "BroadcastHashJoin" not in text

import pytest
from pyspark.sql import functions as F

from goldseam.operators import changes

DDL = "id STRING, name STRING, qty INT"


@pytest.fixture
def target(frame):
    return frame([("1", "a", 1), ("3", "c", None), ("A1", "x", 9), (None, "n", 0)], DDL)


def test_upsert_casts_updates_and_inserts(target, frame, values):
    source = frame([(3, "new c", None), (4, "d", "7"), (None, "m", "1")], "id INT, name STRING, qty STRING")
    merged = changes.upsert(target, source, ["id"])
    assert merged.dtypes == target.dtypes
    assert values(merged) == [
        (None, "m", 1), (None, "n", 0), ("1", "a", 1), ("3", "new c", None), ("4", "d", 7), ("A1", "x", 9),
    ]


def test_upsert_is_idempotent_and_updates_every_copy(target, frame, values):
    source = frame([("1", "z", 5), ("8", "y", 6)], DDL)
    once = changes.upsert(target.unionByName(target), source, ["id"])
    assert values(changes.upsert(once, source, ["id"])) == values(once)
    assert once.filter("id = '1' AND name = 'z'").count() == 2


def test_upsert_refuses_ambiguous_sources(target, frame):
    source = frame([("8", "y", 6), ("8", "z", 6)], DDL)
    with pytest.raises(Exception, match="several source rows"):
        changes.upsert(target, source, ["id"]).collect()
    twice_null = frame([(None, "y", 6), (None, "z", 6)], DDL)
    assert changes.upsert(target, twice_null, ["id"]).count() == 6


def test_upsert_of_nothing(target, frame, values):
    assert values(changes.upsert(target, frame([], DDL), ["id"])) == values(target)


def test_update_and_delete_leave_null_conditions_alone(target, values):
    updated = changes.update_where(target, F.col("qty") < 5, {"qty": F.col("qty") + 1.0, "name": F.upper("name")})
    assert updated.dtypes == target.dtypes
    assert values(updated) == [(None, "N", 1), ("1", "A", 2), ("3", "c", None), ("A1", "x", 9)]
    assert values(changes.delete_where(target, F.col("qty") > 0).select("name")) == [("c",), ("n",)]


@pytest.fixture
def log(frame):
    return frame(
        [
            ("k", "v1", "insert", 1, "2024-01-01 00:00:00"),
            ("k", "v2", "update", 2, "2024-01-02 00:00:00"),
            ("k", None, "delete", 3, "2024-01-03 00:00:00"),
            ("k", "v4", "insert", 4, "2024-01-04 00:00:00"),
            ("j", "w1", "insert", 2, "2024-01-02 00:00:00"),
        ],
        "id STRING, v STRING, op STRING, version INT, ts STRING",
    ).withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.mark.parametrize(
    "version, expected",
    [(0, []), (1, [("k", "v1")]), (2, [("j", "w1"), ("k", "v2")]), (3, [("j", "w1")]), (4, [("j", "w1"), ("k", "v4")])],
)
def test_as_of_versions(log, values, version, expected):
    assert values(changes.as_of(log, ["id"], version=version)) == expected
    assert values(changes.as_of(log, ["id"], ts=f"2024-01-0{version} 12:00:00" if version else "2023-01-01")) == expected


def test_latest_state_and_history(log, values):
    assert values(changes.as_of(log, ["id"])) == [("j", "w1"), ("k", "v4")]
    history = changes.change_history(log).select("version", "op", "n_changes")
    assert values(history) == [(1, "insert", 1), (2, "insert", 1), (2, "update", 1), (3, "delete", 1), (4, "insert", 1)]


def test_null_payload_survives(frame, values):
    log = frame([(1, "x", "insert", 1, None), (1, None, "update", 2, None)], "id INT, v STRING, op STRING, version INT, ts TIMESTAMP")
    assert values(changes.as_of(log, ["id"])) == [(1, None)]


def test_state_from_snapshots(spark, tmp_path):
    rows = [(k % 5, "delete" if k % 7 == 3 else "upsert", k, k * 10) for k in range(60)]
    log = spark.createDataFrame(rows, "user int, op string, version bigint, ts bigint").withColumn("v", F.col("version") * 2)
    path = str(tmp_path / "log")
    epochs = changes.write_snapshots(log, ["user"], path, 16)
    assert epochs == 4
    for version in (-1, 0, 15, 16, 17, 31, 40, 59, 1000):
        got = sorted(map(tuple, changes.as_of_snapshot(log, ["user"], path, 16, epochs, version).collect()))
        assert got == sorted(map(tuple, changes.as_of(log, ["user"], version=version).collect())), version
    plan = changes.as_of_snapshot(log, ["user"], path, 16, epochs, 40)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(epoch" in plan and "= 2)" in plan
    empty = str(tmp_path / "none")
    assert changes.write_snapshots(log.limit(0), ["user"], empty, 16) == 1

"""Hard negatives against all pairs; bounds of the index; odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldseam.llm.negatives import Block, mine, reaching, share_of

DDL = "vec_id bigint, label int, embedding array<float>"


def plain(rows, every, positives=5, negatives=10, window=(30, 90)):
    """The definition, over all pairs."""
    kept = {}
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        v = [math.floor(256 * float(np.float32(x))) for x in vector]
        if sum(x * x for x in v) < 2**61:
            kept[vec_id] = min(kept.get(vec_id, (label, v)), (label, v))
    out = []
    for a, (label, v) in kept.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), b, other) for b, (other, w) in kept.items() if b != a)
        for s, p, _ in [r for r in scored if r[2] == label][:positives]:
            fit = [r for r in scored if r[2] != label and window[0] * -s <= 100 * -r[0] <= window[1] * -s][:negatives]
            out += [(a, p, rank, b, -s, -t) for rank, (t, b, _) in enumerate(fit, 1)]
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in mine(df, **options).collect())


def test_all_pairs(spark):
    made = np.random.default_rng(5)
    centres = made.normal(size=(3, 40))
    rows = [(k, int(made.integers(3)), [float(x) for x in (centres[k % 3] + made.normal(size=40)) / 8]) for k in range(1500)]
    # A group of equal vectors, more than fit a result, around one anchor.
    rows += [(2000 + k, k % 3, rows[0][2]) for k in range(60)]
    got = found(spark.createDataFrame(rows, DDL).repartition(5), every=50)
    assert got and got == plain(rows, 50)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 2.0]), (1, 1, [1.0]), (2, 2, [0.5, 0.5, 0.5]), (3, 1, None), (4, 1, [nan, 1.0]), (5, 2, [inf]), (6, 2, [None]), (None, 1, [1.0]), (7, None, [1.0]),
        (8, 2, []), (9, 1, []), (10, 2, [1.0, 1.0]), (10, 2, [1.0, 1.0]), (10, 1, [9.0]), (11, 2, [-1.0, -1.0]), (12, 1, [3e38, 1.0]), (20, 3, [1.0, 0.0]), (13, 1, [1e6, 1.0]), (14, 2, [7e5]),
    ]
    df = spark.createDataFrame(rows, DDL).withColumns({c: F.lit("x") for c in ("v", "block", "key", "score", "anchor_id")})
    assert found(df, every=10) == plain(rows, 10)
    assert found(df, every=10, window=(0, 200)) == plain(rows, 10, window=(0, 200))
    assert found(df.limit(0)) == []
    assert found(spark.createDataFrame([(0, 1, [1.0])], DDL)) == []


def test_no_row_is_lost_to_bounds():
    made = random.Random(3)
    for case in range(20):
        d = made.choice([1, 15, 16, 17, 50])
        v = np.array([[made.randint(-300, 300) * (made.random() < 0.3) for _ in range(d)] for _ in range(200)], np.int64)
        row = {"ids": np.arange(200).astype("i8").tobytes(), "labels": bytes(1600), "vectors": v.astype("i2").tobytes(), "kind": "i2"}
        q = v[:20]
        scores = q @ v.T
        least = np.array([int(np.quantile(s, made.choice([0.0, 0.5, 0.99]))) for s in scores], np.int64)
        block = Block(row, np.argsort(-(v * v).sum(0), kind="stable"))
        a, j, s = reaching(block, q[:, np.argsort(-(v * v).sum(0), kind="stable")], least)
        assert sorted(zip(a, j, s)) == sorted((i, k, scores[i, k]) for i, k in zip(*np.nonzero(scores >= least[:, None])))


def test_windows_of_whole_numbers(spark):
    values = [0, 1, -1, 7, -7, 101, 2**61, -(2**61) + 3]
    df = spark.createDataFrame([(v,) for v in values], "s bigint")
    got = df.select("s", share_of(F.col("s"), 30, True), share_of(F.col("s"), 90, False)).collect()
    assert [tuple(r) for r in got] == [(v, -(-30 * v // 100), 90 * v // 100) for v in values]


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_thresholds_do_not_change_results(spark, rounds):
    from goldseam.llm.negatives import HIGHEST, LOWEST, _Space

    rows = [(k, k % 2, [math.sin(k), math.cos(k * k), 5.0 * (k % 40 == 3)]) for k in range(400)]
    space = _Space(spark.createDataFrame(rows, DDL), 40, 256, None)
    asked = space.anchors.select("anchor_id", F.lit(1).cast("bigint").alias("key"), F.lit(LOWEST).alias("lo"), F.lit(HIGHEST).alias("hi"))
    got = sorted(tuple(r) for r in space.search(asked, False, 7, rounds).select("anchor_id", "rank", "other_id", "score").collect())
    v = np.floor(256 * np.array([r[2] for r in rows], np.float32).astype(float)).astype(int)
    want = []
    for a in range(0, 400, 40):
        scored = sorted((-int(v[a] @ v[b]), b) for b in range(400) if b % 2 != a % 2)
        want += [(a, rank, b, -s) for rank, (s, b) in enumerate(scored[:7], 1)]
    assert got == sorted(want)

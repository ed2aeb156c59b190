import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldseam.operators import scoring
from goldseam.operators.quality import quality_report


def test_label_index_is_dense_and_sorted_over_many_partitions(spark):
    rng = random.Random(2)
    names = {"".join(rng.choices(string.ascii_letters + "é ñ", k=rng.randint(1, 6))) for _ in range(3000)}
    rows = [(n,) for n in names for _ in range(2)] + [(None,)]
    df = spark.createDataFrame(rows, "label STRING").repartition(5)
    found = {r["label"]: r["label_id"] for r in scoring.label_index(df, "label").collect()}
    assert found == {n: i for i, n in enumerate(sorted(names, key=lambda s: s.encode()))}
    assert scoring.label_index(df.limit(0), "label").count() == 0


def test_split_is_a_stable_partition(spark):
    df = spark.range(5000).withColumn("label", F.col("id") % 3)
    one = scoring.hash_split(df, "id")
    again = scoring.hash_split(df.repartition(7, "label"), "id")
    sides = {r["id"]: r["split"] for r in one.collect()}
    assert sides == {r["id"]: r["split"] for r in again.collect()}
    share = sum(s == "validation" for s in sides.values()) / 5000
    assert 0.17 < share < 0.23
    assert {r["id"]: r["split"] for r in scoring.hash_split(df, "id", seed=1).collect()} != sides
    counts = scoring.split_distribution(df, "id", "label").groupBy("split").agg(F.sum("pct"), F.sum("n")).collect()
    assert sum(r[2] for r in counts) == 5000 and all(abs(r[1] - 100) < 0.05 for r in counts)


def test_accuracy(frame, values):
    df = frame([(0, 0), (0, 1), (0, 0), (1, 1), (2, None)], "label INT, predicted INT")
    assert values(scoring.class_accuracy(df, "label", "predicted")) == [
        (0, 3, 2, 0.6667, 0.6), (1, 1, 1, 1.0, 0.6), (2, 1, 0, 0.0, 0.6),
    ]


def test_train_save_load_classify(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [(i, (rng.normal(size=3) + 4 * np.eye(3)[i % 3]).tolist(), i % 3) for i in range(300)] + [(301, None, 1)]
    df = spark.createDataFrame(rows, "id INT, features ARRAY<DOUBLE>, label INT")
    model = scoring.train_classifier(df, "features", "label")
    scoring.save_model(model, str(tmp_path / "model"))
    known = df.filter("features IS NOT NULL")
    out = scoring.classify(scoring.load_model(str(tmp_path / "model")), known, "features")
    assert out.columns == ["id", "features", "label", "predicted"]
    assert scoring.class_accuracy(out, "label", "predicted").first()["overall_accuracy"] > 0.95


def length_scorer():
    """A maker of scorers that tell classes by the length of the binary content."""
    return lambda: lambda batch: np.array([[float(len(x)), 2.0, 0.0] for x in np.ravel(batch)])


@pytest.mark.parametrize("batch_size", [1, 2, 100])
def test_score_binary_content(frame, batch_size):
    rows = [("a", bytearray(b"12345")), ("b", bytearray(b"")), ("c", None), ("d", bytearray(b"xy"))]
    df = frame(rows, "image_name STRING, content BINARY")
    out = scoring.score_batches(df, length_scorer(), "content", ["dent", "crack", "glass"], batch_size=batch_size)
    found = {r["image_name"]: r for r in out.collect()}
    assert {n: r["label"] for n, r in found.items()} == {"a": "dent", "b": "crack", "d": "dent"}
    expected = np.exp([0.0, 2.0, 0.0]) / np.exp([0.0, 2.0, 0.0]).sum()
    assert found["b"]["score"] == round(expected[1], 4)
    assert found["b"]["all_scores"] == dict(zip(["dent", "crack", "glass"], np.round(expected, 4)))


def test_prediction_contract(frame):
    df = scoring.with_confidence(
        frame([("dent", 0.8), ("odd", 0.4), (None, 0.5), ("dent", 1.5), (None, None)], "label STRING, score DOUBLE"),
        "label",
        "score",
    )
    assert [tuple(r)[2:] for r in df.collect()] == [
        ("alta", True, False), ("baja", False, False), ("media", True, True), ("alta", True, False), ("baja", None, True),
    ]
    report = quality_report(df, scoring.contract_rules("label", "score", ["dent"]))
    assert {r["rule"]: r["failures"] for r in report.collect()} == {
        "score_out_of_range": 1, "unknown_label": 1, "reliable_without_label": 1,
    }


def test_enrich_predictions_keeps_unmatched(frame, values):
    predictions = frame([("i1", "dent"), ("i2", "crack")], "image_name STRING, label STRING")
    metadata = frame([("i1", 7, "ch")], "image_name STRING, claim_no INT, chassis_no STRING")
    out = scoring.enrich_predictions(predictions, metadata, "image_name")
    assert out.columns == ["image_name", "label", "claim_no", "chassis_no"]
    assert values(out) == [("i1", "dent", 7, "ch"), ("i2", "crack", None, None)]

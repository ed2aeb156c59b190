"""Labels, splits, scoring and classification over the embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldseam.functions.scores import argmax, softmax, top_positions
from goldseam.operators import scoring
from goldseam.plans.bound.registry import Tables, query, sql_div, sql_pct
from goldseam.session import checkpointed

N_FEATURES = 64
LABELS = [f"class_{c}" for c in range(10)]


@query(
    """
    SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) - 1 AS INTEGER) AS label_id
    FROM (SELECT DISTINCT p_type FROM part)
    """
)
def label_index(t: Tables) -> DataFrame:
    return scoring.label_index(t.part, "p_type")


@query(
    f"""
    WITH s AS (SELECT o_orderstatus, CASE WHEN CAST('0x' || substr(md5('42:' || o_orderkey), 1, 8) AS BIGINT) % 10000
            < 2000 THEN 'validation' ELSE 'train' END AS split FROM orders),
    c AS (SELECT split, o_orderstatus, count(*) AS n FROM s GROUP BY ALL),
    w AS (SELECT split, sum(n) AS size FROM c GROUP BY split)
    SELECT c.split, o_orderstatus, n, {sql_pct("n", "size")} AS pct FROM c JOIN w ON c.split = w.split
    """
)
def split_counts(t: Tables) -> DataFrame:
    """Class distribution on both sides of a keyed 80/20 split."""
    return scoring.split_distribution(t.orders, "o_orderkey", "o_orderstatus")


@query(
    """
    WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
    p AS (SELECT vec_id, v, list_transform(v, lambda x: exp(x - list_max(v))) AS powers FROM e)
    SELECT vec_id, CAST(list_position(v, list_max(v)) - 1 AS INTEGER) AS best,
           round(list_max(powers) / list_sum(powers), 6) AS score FROM p
    """
)
def softmax_argmax(t: Tables) -> DataFrame:
    shares = softmax("embedding")
    return t.embeddings.select(
        "vec_id", argmax("embedding").alias("best"), F.round(F.array_max(shares), 6).alias("score")
    )


@query(
    """
    SELECT vec_id, array_to_string(list_transform(list_sort(list_transform(embedding, lambda x, i: {'neg': -x, 'pos': i}))
        [1:3], lambda s: s.pos - 1), ',') AS best FROM embeddings
    """
)
def topk_scores(t: Tables) -> DataFrame:
    best = F.transform(top_positions("embedding", 3), lambda i: i.cast("string"))
    return t.embeddings.select("vec_id", F.array_join(best, ",").alias("best"))


def linear_scorer(n_classes: int, n_features: int):
    """A maker of scorers with fixed weights, standing in for a trained model.

    The inner functions travel to the workers by value, so these need numpy only.
    """

    def make():
        classes, features = np.meshgrid(np.arange(n_classes), np.arange(n_features), indexing="ij")
        weights = ((classes * 7 + features * 3) % 11 - 5) / 5.0
        return lambda batch: batch.astype(np.float64) @ weights.T

    return make


@query(
    """
    WITH l AS (SELECT vec_id, list_transform(range(10), lambda c: list_sum(list_transform(range(64),
            lambda i: ((c * 7 + i * 3) % 11 - 5) / 5.0 * CAST(embedding[i + 1] AS DOUBLE)))) AS logits FROM embeddings),
    p AS (SELECT vec_id, list_transform(logits, lambda x: exp(x - list_max(logits))) AS powers FROM l),
    s AS (SELECT vec_id, list_transform(powers, lambda x: x / list_sum(powers)) AS shares FROM p)
    SELECT vec_id, 'class_' || (list_position(shares, list_max(shares)) - 1) AS label,
        round(list_max(shares), 4) AS score, 'class_' || c AS class_label, round(shares[c + 1], 4) AS class_score
    FROM (SELECT *, unnest(range(10)) AS c FROM s)
    """
)
def score_batches(t: Tables) -> DataFrame:
    scorer = linear_scorer(len(LABELS), N_FEATURES)
    scored = scoring.score_batches(
        t.embeddings.select("vec_id", "embedding"), scorer, "embedding", LABELS, N_FEATURES
    )
    return scored.select("vec_id", "label", "score", F.explode("all_scores").alias("class_label", "class_score"))


@query(
    """
    WITH p AS (SELECT label, (list_position(embedding, list_max(embedding)) - 1) % 10 AS predicted FROM embeddings),
    c AS (SELECT label, count(*) AS n, count(*) FILTER (WHERE label = predicted) AS correct FROM p GROUP BY label)
    SELECT label, n, correct, CAST((2 * correct * 10000 + n) // (2 * n) AS DOUBLE) / 10000 AS accuracy,
        CAST((2 * (SELECT sum(correct) FROM c) * 10000 + (SELECT sum(n) FROM c)) // (2 * (SELECT sum(n) FROM c)) AS DOUBLE)
            / 10000 AS overall_accuracy
    FROM c
    """
)
def class_accuracy(t: Tables) -> DataFrame:
    guessed = t.embeddings.select("label", (argmax("embedding") % 10).alias("predicted"))
    return scoring.class_accuracy(guessed, "label", "predicted")


@query(
    f"""
    WITH e AS (
        SELECT vec_id, label, embedding, CASE WHEN CAST('0x' || substr(md5('42:' || vec_id), 1, 8) AS BIGINT) % 10000 < 2000
            THEN 'validation' ELSE 'train' END AS split FROM embeddings
    ), d AS (
        SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM e WHERE split = 'train'
    ), c AS (
        SELECT label, dim, sum(CAST(round(CAST(x AS DOUBLE) * 1048576) AS BIGINT)) / count(*) / 1048576 AS c FROM d GROUP BY ALL
    ), m AS (
        SELECT label AS class, list(c ORDER BY dim) AS centroid FROM c GROUP BY label
    ), f AS (
        SELECT vec_id, label, class, list_distance(CAST(embedding AS DOUBLE[]), centroid) AS far FROM e, m WHERE split = 'validation'
    ), p AS (
        SELECT label, arg_min(class, row(far, class)) AS predicted FROM f GROUP BY vec_id, label
    ), n AS (
        SELECT label, count(*) AS n, count(*) FILTER (WHERE label = predicted) AS correct FROM p GROUP BY label
    ), w AS (SELECT sum(n) AS n, sum(correct) AS correct FROM n)
    SELECT label, n.n, n.correct, {sql_div("n.correct * 10000", "n.n", 4)} AS accuracy, {sql_div("w.correct * 10000", "w.n", 4)} AS overall_accuracy
    FROM n, w
    """
)
def train_classifier(t: Tables) -> DataFrame:
    """Accuracy per class on the held-out keys of class centroids learned from the others."""
    split = scoring.hash_split(t.embeddings, "vec_id")
    centroids = checkpointed(scoring.class_centroids(split.filter("split = 'train'"), "embedding", "label"))
    found = scoring.nearest_centroid(split.filter("split = 'validation'"), centroids, "embedding")
    return scoring.class_accuracy(found, "label", "predicted")

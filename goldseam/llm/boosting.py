"""Quality classifier: histogram gradient-boosted trees over document statistics.

Features are the statistics of a whole text (``textstats``) with its logarithmic size. They are cut into
quantile bins; each tree grows level by level on gradient and curvature histograms of the bins,
for the log loss. A fitted model is flat arrays, and all rows of a batch walk a tree together,
one numpy step per level.

Learnt from a bounded sample of labelled rows; only its statistics reach the driver, a few
numbers a row. Texts: null and empty ones score by the statistics of an empty text. Repeated rows
score alike, and a null doc_id is kept. Without labels of both classes every score is the share of
good labels, 0.5 without any.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldseam.llm.common import by_id, held_out, labelled_sample
from goldseam.llm.textstats import base_statistics, shares


def features(texts: list[bytes | None]) -> np.ndarray:
    rows = []
    for text in texts:
        stats = base_statistics(text)
        rows.append([*shares(stats), float(np.log1p(stats["n_words"])), float(np.log1p(stats["n_lines"]))])
    return np.array(rows, dtype=np.float64).reshape(len(texts), 13)


@dataclass
class Forest:
    """Trees of one depth as arrays: node k of a level has children 2k and 2k+1 of the next."""

    depth: int
    prior: float
    feature: np.ndarray  # trees x inner nodes, level by level
    cut: np.ndarray  # trees x inner nodes: larger values go right
    leaf: np.ndarray  # trees x 2**depth

    def logits(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for level in range(self.depth):
                at = node + (1 << level) - 1
                node = 2 * node + (x[rows, feature[at]] > cut[at])
            total += leaf[node]
        return total

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logits(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
        ridge: float = 2.0, least: float = 4.0, weight: np.ndarray | None = None) -> Forest:
    """Boost ``trees`` trees; a split must leave curvature of at least ``least`` on both sides. Ties take the
    first feature and the lowest cut."""
    n, width = x.shape
    w = np.ones(n) if weight is None else weight
    share = float((y * w).sum() / w.sum()) if n else 0.5
    inner = (1 << depth) - 1
    empty = Forest(depth, 0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, 1 << depth)))
    if not n or not 0 < share < 1:
        empty.prior = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        return empty
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(width)]
    codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)  # value <= cut[b] is code <= b
    model = Forest(depth, float(np.log(share / (1 - share))), *([] for _ in range(3)))
    logit = np.full(n, model.prior)
    offsets = codes + np.arange(width) * bins
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        slope, bend = w * (y - p), w * p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            nodes = 1 << level
            cell = (node[:, None] * (width * bins) + offsets).ravel()
            shape = (nodes, width, bins)
            g = np.bincount(cell, np.repeat(slope, width), nodes * width * bins).reshape(shape).cumsum(2)
            h = np.bincount(cell, np.repeat(bend, width), nodes * width * bins).reshape(shape).cumsum(2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
            gain[(h < least) | (h_all - h < least)] = 0
            flat = gain.reshape(nodes, -1)
            best = flat.argmax(1)
            for k in range(nodes):
                if flat[k, best[k]] > 1e-6:
                    j, b = divmod(int(best[k]), bins)
                    feature[nodes - 1 + k], cut[nodes - 1 + k] = j, cuts[j][b]
            at = node + nodes - 1
            node = 2 * node + (x[np.arange(n), feature[at]] > cut[at])
        size = 1 << depth
        leaf = rate * np.bincount(node, slope, size) / (np.bincount(node, bend, size) + ridge)
        logit += leaf[node]
        for store, value in ((model.feature, feature), (model.cut, cut), (model.leaf, leaf)):
            store.append(value)
    model.feature, model.cut, model.leaf = (np.array(v) for v in (model.feature, model.cut, model.leaf))
    return model


def train(docs: DataFrame, labels: DataFrame, per_class: int = 8_000, max_bytes: int = 1_000_000, **options) -> Forest:
    """Fit on about ``per_class`` learnable labelled texts of each class, so classes weigh about alike.

    The statistics are taken in the tasks; the driver holds 13 numbers for a sampled row.
    """

    def measured(batches):
        for batch in batches:
            x = features(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    sample = labelled_sample(docs, labels, "quality", per_class, max_bytes)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = by_id(sample.mapInArrow(measured, f"doc_id {kind}, label int, x array<double>").toArrow(), "doc_id")
    x = np.array(rows["x"].to_pylist(), dtype=np.float64).reshape(rows.num_rows, 13)
    order = np.lexsort((*x.T, rows["doc_id"].to_numpy(zero_copy_only=False)))  # equal ids must not depend on tasks
    return fit(x[order], np.array(rows["label"].to_pylist(), dtype=np.float64)[order], **options)


def score(docs: DataFrame, model: Forest) -> DataFrame:
    """doc_id, score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for batch in batches:
            scores = shared.value.predict(features(batch["text"].to_pylist()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(scored, f"doc_id {kind}, score double")


def grade(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``threshold`` up) of every document."""
    return score(docs, train(docs, labels, **options)).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )

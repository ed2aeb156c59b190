"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with boundary marks) and itself, all hashed into one
table of embeddings; a window of words is the average of its words, and a two-class softmax over
that average scores it. A document scores as its most toxic window, since a few words make a text
toxic however long it is. Embeddings and softmax are trained together on windows. An unseen
misspelling shares n-grams, and so vectors, with words seen.

The average and the softmax are linear, so a word's part in a window's logit is one number. Scoring
looks that number up per word and slides a running sum over the whole text.

Texts: null or without a word scores as an empty window, sigmoid(bias). Words are maximal runs of
letters, digits and non-ASCII characters but blanks and punctuation of the lower-cased text; a run of more than PIECE bytes (text
without blanks, as in Chinese or Thai) is cut into overlapping pieces, each a word. Repeated rows score alike; a
null doc_id is scored and kept null. Without labels of both classes every score is the share of
toxic labels (0 without any).
"""

from __future__ import annotations

import re
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldseam.llm.common import by_bytes, by_id, held_out, labelled_sample, trimmed

WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

#: Bytes of a word that is scored as one, and what neighbouring pieces of a longer one share.
PIECE, OVERLAP = 64, 16
#: Blanks and punctuation beyond ASCII: no-break spaces, dashes, quotation marks, full-width punctuation.
SEPARATORS = re.compile("[" + "".join(c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c)[0] in "ZP") + "]+")

#: Elements that a step of the fit looks at together.
SLICE = 1 << 18


def words_of(text: bytes | None) -> list[bytes]:
    if not text:
        return []
    lower = text.decode("utf-8", "replace").lower()
    if not lower.isascii():
        lower = SEPARATORS.sub(" ", lower)
    words = lower.encode("utf-8", "replace").translate(WORD_BYTES).split()
    if not words or len(max(words, key=len)) <= PIECE:
        return words
    return [piece for word in words for piece in pieces(word)]


def pieces(word: bytes) -> list[bytes]:
    """The word, or if it is longer than PIECE bytes, pieces of at most that many that together hold all of it.

    Neighbours share OVERLAP bytes, so that any n-gram of up to OVERLAP + 1 bytes lies in a piece.
    """
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in range(0, len(word) - OVERLAP, PIECE - OVERLAP)]


def subwords(word: bytes, buckets: int, least: int, most: int) -> list[int]:
    """Buckets of the word and of its n-grams of ``least`` to ``most`` bytes."""
    marked = b"<" + word + b">"
    grams = [marked[i : i + n] for n in range(least, most + 1) for i in range(len(marked) - n + 1)]
    return [zlib.crc32(g) % buckets for g in (*grams, b"=" + word)]


@dataclass
class ToxicityModel:
    buckets: int
    least: int
    most: int
    window: int
    embeddings: np.ndarray  # buckets x dim
    softmax: np.ndarray  # dim x 2
    bias: np.ndarray  # 2

    def gram_logits(self) -> np.ndarray:
        """Of each bucket, what it adds to a logit before averaging."""
        return (self.embeddings @ (self.softmax[:, 1] - self.softmax[:, 0])).astype(np.float64)


class _WordLogits(dict):
    """Logit part of each word met, computed on first sight; emptied when full, so its memory is bounded."""

    def __init__(self, model: ToxicityModel, limit: int = 300_000):
        super().__init__()
        self.model, self.limit, self.grams = model, limit, model.gram_logits()

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.limit:
            self.clear()
        m = self.model
        self[word] = value = float(self.grams[subwords(word, m.buckets, m.least, m.most)].mean())
        return value


def window_logit(parts: np.ndarray, window: int) -> float:
    """The largest mean over windows of that many words; of all words if there are fewer, 0 without any."""
    if not len(parts):
        return 0.0
    if len(parts) <= window:
        return float(parts.mean())
    sums = np.concatenate(([0.0], np.cumsum(parts)))
    return float((sums[window:] - sums[:-window]).max() / window)


def slices(bounds: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of consecutive entries, ``bounds`` being where each begins and the last ends, of about SLICE elements or one entry."""
    cuts = [0]
    while cuts[-1] < len(bounds) - 1:
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(bounds, bounds[cuts[-1]] + SLICE, "right")) - 1))
    return list(pairwise(cuts))


def most_toxic(parts: np.ndarray, words: np.ndarray, window: int) -> np.ndarray:
    """The window of that many of ``words`` with the largest sum of ``parts``; all words if there are fewer."""
    if len(words) <= window:
        return words
    sums = np.concatenate(([0.0], np.cumsum(parts[words])))
    at = int((sums[window:] - sums[:-window]).argmax())
    return words[at : at + window]


def descend(x: np.ndarray, seen: np.ndarray, slope: np.ndarray, rate: float) -> None:
    """One step of Adagrad, in place."""
    seen += slope**2
    x -= (rate * slope / np.sqrt(seen)).astype(x.dtype)


def fit(texts: Iterable[bytes], labels: np.ndarray, buckets: int = 1 << 17, dim: int = 8, least: int = 3, most: int = 7,
        window: int = 2, epochs: int = 80, rate: float = 0.3, seed: int = 5) -> ToxicityModel:
    """Train on whole texts: first on averages over a text's distinct words, then on its most toxic window.

    The loss is the class-balanced log loss; steps are Adagrad's over all texts at once, so that
    the result does not depend on the order of rows. Texts are read once, one at a time; steps go
    by slices, so that beyond words and n-grams the fit holds little.
    """
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, dtype=np.float64)
    share = float(labels.mean()) if len(labels) else 0.0
    model = ToxicityModel(
        buckets, least, most, window, (rng.standard_normal((buckets, dim)) * 0.01).astype(np.float32),
        np.stack([-np.ones(dim), np.ones(dim)], 1) * 0.5, np.zeros(2),
    )
    if not 0 < share < 1:
        chance = min(max(share, 1e-9), 1 - 1e-9)
        model.embeddings[:] = 0
        model.bias = np.array([np.log(1 - chance), np.log(chance)])
        return model
    bags, windows = array("i"), array("i")  # compact: the driver holds every word of the sample, and every n-gram of its words
    bag_ends, ends, flat, sizes = [0], [0], array("i"), array("i")
    ids: dict[bytes, int] = {}
    for text in texts:
        for word in words_of(text):
            at = ids.setdefault(word, len(ids))
            if at == len(sizes):
                grams = subwords(word, buckets, least, most)
                flat.extend(grams)
                sizes.append(len(grams))
            windows.append(at)
        bags.extend(sorted(set(windows[ends[-1] :])))
        ends.append(len(windows))
        bag_ends.append(len(bags))
    del ids
    flat, sizes, bags, windows = (np.frombuffer(x, np.int32) if x else np.zeros(0, np.int32) for x in (flat, sizes, bags, windows))
    starts = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    weight = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share)) / len(labels)
    seen_e, seen_s, seen_b = (np.full(x.shape, 1e-8) for x in (model.embeddings, model.softmax, model.bias))
    word_slices = slices(starts)
    for epoch in range(epochs):
        logits = model.gram_logits().astype(np.float32)
        parts = np.zeros(len(sizes))
        for i, j in word_slices:
            parts[i:j] = np.add.reduceat(logits[flat[starts[i] : starts[j]]], starts[i:j] - starts[i])
        parts /= sizes
        if epoch < epochs // 4:
            used, bounds = bags, np.array(bag_ends)
        else:
            picked = [most_toxic(parts, windows[i:j], window) for i, j in pairwise(ends)]
            used, bounds = np.concatenate(picked), np.cumsum([0, *map(len, picked)])
        error, by_word = np.zeros(len(labels)), np.zeros(len(sizes))
        for i, j in slices(bounds):
            lengths = np.diff(bounds[i : j + 1])
            which, words = np.repeat(np.arange(j - i), lengths), used[bounds[i] : bounds[j]]
            logit = np.bincount(which, parts[words] / lengths[which], j - i) + model.bias[1] - model.bias[0]
            error[i:j] = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels[i:j]) * weight[i:j]
            np.add.at(by_word, words, (error[i:j] / np.maximum(lengths, 1))[which])
        by_word /= sizes
        by_gram = np.zeros(buckets)
        for i, j in word_slices:
            np.add.at(by_gram, flat[starts[i] : starts[j]], np.repeat(by_word[i:j], sizes[i:j]))
        direction = model.softmax[:, 1] - model.softmax[:, 0]
        towards = by_gram @ model.embeddings
        for i in range(0, buckets, SLICE // dim):
            rows = slice(i, i + SLICE // dim)
            descend(model.embeddings[rows], seen_e[rows], by_gram[rows, None] * direction, rate)
        descend(model.softmax, seen_s, np.stack([-towards, towards], 1), rate)
        descend(model.bias, seen_b, np.array([-error.sum(), error.sum()]), rate)
    return model


def score_texts(texts: list[bytes | None], model: ToxicityModel, cache: _WordLogits) -> np.ndarray:
    get = cache.__getitem__
    logits = np.array(
        [window_logit(np.fromiter(map(get, words_of(t)), dtype=np.float64), model.window) for t in texts], dtype=np.float64
    )
    return 1 / (1 + np.exp(-(logits + model.bias[1] - model.bias[0])))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2_500, max_bytes: int = 200_000, **options) -> ToxicityModel:
    """Fit on about ``per_class`` learnable labelled texts of each class, of at most ``max_bytes`` each."""
    sample = by_id(labelled_sample(docs, labels, "toxic", per_class, max_bytes).toArrow(), "doc_id", "text")
    marks, texts = np.array(sample["label"].to_pylist(), dtype=np.float64), (text.as_py() for text in sample["text"])
    del sample  # the generator alone holds the texts, until the last is read
    return fit(texts, marks, **options)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score of every whole text of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        cache = _WordLogits(shared.value)
        for batch in batches:
            scores = score_texts(batch["text"].to_pylist(), shared.value, cache)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(scored, f"doc_id {kind}, score double")


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``threshold`` up) of every document."""
    return score(docs, train(docs, labels, **options)).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """``docs`` without the texts that score ``threshold`` or more; every other row stays as it is."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, **options))

    def kept(batches):
        cache = _WordLogits(shared.value)
        for batch in by_bytes(batches, "text", 2 << 20):
            scores = score_texts(batch["text"].cast(pa.binary()).to_pylist(), shared.value, cache)
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(trimmed(kept), docs.schema)

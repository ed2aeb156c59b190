"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of 0 to 3 bytes with the bytes seen after each (a text
begins as if after line ends). The code length of a byte follows its longest context; a byte not
seen there costs an escape, by method C (distinct bytes over occurrences plus distinct bytes), and is
coded in the next shorter context with the bytes already ruled out excluded; below all contexts all
bytes not seen at all are alike. Statistics are frozen after learning, so that the code length of a byte
is a fixed function of it and its three predecessors: it is computed once for every 1 to 4 bytes
any language has seen. Scoring walks down to the longest known string at all positions of a batch at once,
and adds up table rows. The shortest code wins, ties by language name; the score is that
language's posterior probability under equal priors, 2 to the minus code length.

Null texts and texts without a letter are ``und`` with score 0, and so is everything if nothing was
learnt. Repeated rows are predicted alike; a null doc_id is kept and never learnt from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from goldseam.llm.common import class_sample, held_out, learnable

DEPTH = 4  # bytes of the longest string: three of context and the byte itself
START = b"\n" * (DEPTH - 1)
UNKNOWN = "und"


def quads(text: bytes) -> np.ndarray:
    """Every byte with its three predecessors as one number."""
    b = np.frombuffer(START + text, np.uint8).astype(np.int64)
    return (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]


def count_strings(docs: DataFrame, per_language: int, max_bytes: int, max_strings: int) -> DataFrame:
    """lang, quad, n over a sample of learnable texts; of each language the ``max_strings`` most frequent."""

    def counted(batches):
        totals: dict[str, dict[int, int]] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                found, n = np.unique(quads(text), return_counts=True)
                mine = totals.setdefault(lang, {})
                for q, k in zip(found.tolist(), n.tolist()):
                    mine[q] = mine.get(q, 0) + k
            if sum(map(len, totals.values())) > 200_000:  # keeps memory bounded; equal strings add up later
                yield from rows(totals)
                totals = {}
        yield from rows(totals)

    def rows(totals):
        for lang, mine in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(mine), pa.string()), pa.array(mine.keys(), pa.int64()), pa.array(mine.values(), pa.int64())],
                ["lang", "quad", "n"],
            )

    keys = docs.where(learnable("doc_id") & F.col("lang").isNotNull() & (F.length("lang") > 0)).where(F.octet_length("text") <= max_bytes)
    chosen = class_sample(keys.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("binary").alias("text")), "doc_id", "lang", per_language)
    counts = chosen.mapInArrow(counted, "lang string, quad bigint, n bigint").groupBy("lang", "quad").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "quad")
    return counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= max_strings).drop("_rank")


@dataclass
class ContextModel:
    """Strings of k bytes known to any language are numbered 1..; 0 stands for unknown."""

    languages: list[str]
    step: list[np.ndarray]  # step[k][number of the first k bytes, next byte] -> number of k + 1 bytes
    cost: list[np.ndarray]  # cost[k][number of k bytes, language]: bits of the last byte after the others
    escape: list[np.ndarray]  # escape[k][number of k bytes, language]: bits to leave that context


def build(languages: list[str], counts: list[tuple[np.ndarray, np.ndarray]]) -> ContextModel:
    """Freeze the statistics: quads and their counts, one pair of arrays per language."""
    width = len(languages)
    strings, tallies = [], []  # per length k: sorted distinct strings of k bytes; counts x language
    for k in range(1, DEPTH + 1):
        mask = (1 << (8 * k)) - 1
        # What stands before a text is a context too, whether or not some text ends with it.
        before = [[int.from_bytes(START[:k], "big")]] if k < DEPTH else []
        known = np.unique(np.concatenate([*(q & mask for q, _ in counts), *before]).astype(np.int64))
        tally = np.zeros((len(known) + 1, width))
        for j, (q, n) in enumerate(counts):
            np.add.at(tally[:, j], np.searchsorted(known, q & mask) + 1, n)
        strings.append(known)
        tallies.append(tally)
    step = [np.zeros((1, 256), np.int32)]
    step[0][0, strings[0]] = np.arange(1, len(strings[0]) + 1)
    context_of = [np.zeros(len(strings[0]), np.int64)]  # row of the context, which is itself a string or the empty one
    for k in range(2, DEPTH + 1):
        s = strings[k - 1]
        place = np.searchsorted(strings[k - 2], s >> 8)
        found = (place < len(strings[k - 2])) & (strings[k - 2][np.minimum(place, len(strings[k - 2]) - 1)] == s >> 8)
        context_of.append(np.where(found, place + 1, 0))
        grid = np.zeros((len(strings[k - 2]) + 1, 256), np.int32)
        grid[context_of[-1][found], (s & 255)[found]] = np.arange(1, len(s) + 1)[found]
        step.append(grid)
    # Bottom up. After the empty context all bytes it has not seen share what is left.
    uniform = np.full((256, width), 1 / 256.0)
    probability, escape = [], []
    for k in range(1, DEPTH + 1):
        s, tally, rows = strings[k - 1], tallies[k - 1][1:], context_of[k - 1]
        contexts = 1 if k == 1 else len(strings[k - 2]) + 1
        seen = tally > 0
        # Strings whose context was cut from the statistics cannot be reached; row 0 is no context.
        seen[(rows == 0) & (k > 1)] = False
        tally = np.where(seen, tally, 0.0)
        total, distinct, shorter_seen = (np.zeros((contexts, width)) for _ in range(3))
        # Of each string, the probability its last byte has in the context one shorter.
        if k == 1:
            shorter = uniform[s & 255]
        else:
            at = np.searchsorted(strings[k - 2], s & ((1 << (8 * (k - 1))) - 1))
            shorter = probability[-1][at + 1]
        for array, value in ((total, tally), (distinct, seen), (shorter_seen, np.where(seen, shorter, 0.0))):
            np.add.at(array, rows, value)
        left = np.maximum(1 - shorter_seen, 1e-9)
        used = total > 0
        leave = np.where(used, distinct / np.maximum(total + distinct, 1) / left, 1.0)
        p = np.where(seen, tally / np.maximum(total + distinct, 1)[rows], leave[rows] * shorter)
        probability.append(np.vstack([np.zeros((1, width)), p]))
        escape.append(leave)
    cost = [np.where(p > 0, -np.log2(np.maximum(p, 1e-30)), 0.0) for p in probability]
    escape = [-np.log2(np.maximum(e, 1e-30)) for e in escape]
    return ContextModel(languages, step, cost, escape)


def code_lengths(text: bytes, model: ContextModel, block: int = 1 << 20) -> np.ndarray:
    """Bits of the whole text under each language; long texts go block by block, with the bytes before a block."""
    total = np.zeros(len(model.languages))
    data = np.frombuffer(START + text, np.uint8)
    for begin in range(0, len(text), block):
        b = data[begin : begin + block + DEPTH - 1].astype(np.int32)
        known = [np.zeros(len(b), np.int32)]  # known[k][i]: number of the k bytes that end at i
        for k in range(1, DEPTH + 1):
            own = model.step[k - 1].take(known[-1][:-1] * 256 + b[1:])
            known.append(np.concatenate((model.step[0][0, b[:1]] if k == 1 else [0], own)))
        at = np.arange(DEPTH - 1, len(b))
        for k in range(DEPTH, 0, -1):
            rows = known[k][at]
            hit = rows > 0
            if hit.all():
                total += _sum(model.cost[k - 1], rows)
                at = at[:0]
                break
            total += _sum(model.cost[k - 1], rows[hit])
            at = at[~hit]
            total += _sum(model.escape[k - 1], known[k - 1][at - 1])
        total += 8.0 * len(at)  # bytes no language has seen
    return total


def _sum(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.ones(len(rows)) @ table.take(rows, 0)  # far faster than sum() over so few columns


def predict(text: bytes, model: ContextModel) -> tuple[str, float]:
    """The language with the shortest code, and its posterior probability."""
    if not model.languages:
        return UNKNOWN, 0.0
    bits = code_lengths(text, model)
    best = int(bits.argmin())
    return model.languages[best], float(1 / np.exp2(np.minimum(bits[best] - bits, 0)).sum())


def train(docs: DataFrame, per_language: int = 1_500, max_bytes: int = 200_000, max_strings: int = 200_000) -> ContextModel:
    """Learn from about ``per_language`` texts of each language, of at most ``max_bytes`` each."""
    found = count_strings(docs, per_language, max_bytes, max_strings).toArrow().to_pandas()
    languages = sorted(found["lang"].unique())
    counts = [
        (mine["quad"].to_numpy(np.int64), mine["n"].to_numpy(np.float64))
        for mine in (found[found["lang"] == lang].sort_values("quad") for lang in languages)
    ]
    return build(languages, counts) if languages else ContextModel([], [], [], [])


def identify(docs: DataFrame, model: ContextModel | None = None, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text; learns from ``docs`` unless given a model."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs, **options))

    def predicted(batches):
        for batch in batches:
            results = [
                predict(text, shared.value) if letters else (UNKNOWN, 0.0)
                for text, letters in zip(batch["text"].to_pylist(), batch["letters"].to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([r[0] for r in results], pa.string()), pa.array([r[1] for r in results], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    letters = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("letters")
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), letters)
    return rows.mapInArrow(predicted, f"doc_id {kind}, lang_pred string, score double").select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score"
    )

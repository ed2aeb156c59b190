"""Hard-negative mining by threshold joins over an inverted index of vector dimensions.

Components become whole numbers, so scores (inner products) are exact. Anchors are a stated part of the rows and meet all
rows in blocks: rows are packed once into blocks of bounded size, anchors come to every block, and each meeting keeps at most
``k`` rows per request. A request asks for the best rows of an anchor with a score from ``t`` up to ``hi``.

In a block the dimensions go by falling energy, in chunks. A row is posted in the lists of its leading dimensions only: from
where on the norm of its rest times that of every anchor's rest stays below the thresholds, it is left out, as
what is left out alone cannot reach them; many rows are posted nowhere. Partial scores add up chunk by chunk, and rows
whose partial score and remaining norms reach no threshold drop out. What is left is scored exactly.

Thresholds begin where, by mean and spread of the scores, a few times ``k`` rows are expected, and go down for
requests that did not fill, at last to their lower bound. They decide the number of rounds only, never the result.

Rows without vec_id or label, without a vector or with a component that is null or not finite take no part; nor do rows whose
squared norm reaches 2^62, as their scores need not fit into a long (any others' do). A shorter vector ends in zeros, an empty one is
all zeros. vec_id is a key: of rows that share one, the first by label and components takes part. Equal scores go by smaller vec_id.
An anchor without a positive, and a positive without a negative in its window, give no rows.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from goldseam.llm.common import stored

CHUNK = 16
LOWEST, HIGHEST = -(2**62), 2**62
#: Scores of a slice of anchors and a block are held at once: at most this many.
CELLS = 1 << 21


def usable(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, v (whole components) of the rows that take part."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    energy = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.pow(F.lit(float(scale)) * x.cast("double"), F.lit(2.0)) + 2 * scale * F.abs(x.cast("double")) + 1)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # The energy takes each component for one more than it is, as rounding down may.
    kept = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite).where(energy < float(HIGHEST))
    return kept.select("vec_id", F.col("label").cast("bigint").alias("label"), whole.alias("v"))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """A column of lists as int64 rows of ``width``, short ones filled with zeros."""
    sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    made = np.zeros((len(lists), width), np.int64)
    made[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return made


PACKED = "ids binary, labels binary, vectors binary, kind string, sums array<double>, squares array<double>"


def _packer(block_rows: int):
    def pack(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, block_rows):
                part = batch.slice(begin, block_rows)
                lists = part["v"]
                v = matrix(lists, int(np.diff(lists.offsets.to_numpy()).max(initial=0)))
                most = int(np.abs(v).max(initial=0))
                kind = "i2" if most < 2**15 else "i4" if most < 2**31 else "i8"
                f = v.astype(np.float64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "ids": pa.array([part["vec_id"].to_numpy().astype("i8").tobytes()], pa.binary()),
                        "labels": pa.array([part["label"].to_numpy().astype("i8").tobytes()], pa.binary()),
                        "vectors": pa.array([v.astype(kind).tobytes()], pa.binary()),
                        "kind": [kind],
                        "sums": pa.array([f.sum(0)], pa.list_(pa.float64())),
                        "squares": pa.array([(f * f).sum(0)], pa.list_(pa.float64())),
                    }
                )

    return pack


class Block:
    """Packed rows, their dimensions by falling energy, and the norms of what is left of each row before every chunk."""

    def __init__(self, row: dict, order: np.ndarray):
        self.ids = np.frombuffer(row["ids"], "i8")
        self.labels = np.frombuffer(row["labels"], "i8")
        v = np.frombuffer(row["vectors"], row["kind"]).astype(np.int64).reshape(len(self.ids), -1)
        self.v = np.zeros((len(v), len(order)), np.int64)
        self.v[:, : v.shape[1]] = v
        self.v = self.v[:, order]
        self.f = self.v.astype(np.float64)
        self.rest = rests(self.f)


def rests(f: np.ndarray) -> np.ndarray:
    """Norm of each row's components from every chunk on; last, of none."""
    squares = np.add.reduceat(f * f, np.arange(0, f.shape[1], CHUNK), axis=1) if f.shape[1] else np.zeros((len(f), 0))
    tails = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    # Rounding may not make a bound smaller than what it bounds.
    return np.concatenate([np.sqrt(tails) * (1 + 1e-12), np.zeros((len(f), 1))], axis=1)


def reaching(block: Block, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all rows of the block with at least the anchor's ``least`` score."""
    f = q.astype(np.float64)
    q_rest = rests(f)
    # Rounding of partial sums is far below this share of the norms.
    floor = least.astype(np.float64) - 1e-9 * (1 + q_rest[:, :1].max(initial=0.0) * block.rest[:, 0].max(initial=0.0))
    chunks = q_rest.shape[1] - 1
    with np.errstate(divide="ignore", invalid="ignore"):
        # Below this norm of a row's rest, no anchor reaches its threshold by the rest alone.
        idle = np.where(floor[:, None] > 0, np.where(q_rest > 0, floor[:, None] / q_rest, np.inf), -1.0).min(0)
    cut = np.full(len(block.ids), chunks)
    for c in range(chunks, -1, -1):
        cut[block.rest[:, c] < idle[c]] = c
    order = np.argsort(-cut, kind="stable")
    rows = order[: int(np.count_nonzero(cut))]
    scores = np.zeros((len(f), len(rows)))
    for c in range(chunks):
        # The lists of this chunk hold the rows that are posted beyond it, which come first.
        posted = int(np.count_nonzero(cut[rows] > c))
        if posted == 0:
            break
        dims = slice(c * CHUNK, (c + 1) * CHUNK)
        scores[:, :posted] += f[:, dims] @ block.f[rows[:posted], dims].T
        after = np.minimum(cut[rows], c + 1)
        open_ = (scores + q_rest[:, after] * block.rest[rows, after] >= floor[:, None]).any(0)
        if np.count_nonzero(open_) < 0.8 * len(rows):
            rows, scores = rows[open_], scores[:, open_]
    a, j = np.nonzero(scores + q_rest[:, cut[rows]] * block.rest[rows, cut[rows]] >= floor[:, None])
    found = rows[j]
    exact = np.empty(len(a), np.int64)
    step = max(1, CELLS // max(1, q.shape[1]))
    for begin in range(0, len(a), step):
        part = slice(begin, begin + step)
        exact[part] = np.einsum("ij,ij->i", q[a[part]], block.v[found[part]])
    sure = exact >= least[a]
    return a[sure], found[sure], exact[sure]


def best(block: Block, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, asked: list, same: bool, k: int) -> dict[str, np.ndarray]:
    """The k best rows of the block for each request. ``asked``: per anchor its requests (key, t, hi)."""
    least = np.array([min(r["t"] for r in rs) for rs in asked], np.int64)
    a, row, score = reaching(block, q, least)
    wanted = ((labels[a] == block.labels[row]) == same) & (ids[a] != block.ids[row])
    a, row, score = a[wanted], row[wanted], score[wanted]
    order = np.lexsort((block.ids[row], -score, a))
    a, row, score = a[order], row[order], score[order]
    made: list[tuple] = []
    for place in range(max(map(len, asked), default=0)):
        t, hi, key = (np.array([rs[place][n] if place < len(rs) else none for rs in asked], np.int64) for n, none in (("t", 1), ("hi", 0), ("key", 0)))
        inside = (score >= t[a]) & (score <= hi[a])
        at = a[inside]
        first = np.searchsorted(at, at)  # where the anchor's rows begin
        chosen = np.arange(len(at)) - first < k
        made.append((ids[at][chosen], key[at][chosen], block.ids[row[inside]][chosen], score[inside][chosen]))
    columns = [np.concatenate(c) for c in zip(*made)] if made else [np.zeros(0, np.int64)] * 4
    return dict(zip(("anchor_id", "key", "other_id", "score"), columns))


def _scorer(order: np.ndarray, same: bool, k: int):
    """Rows sorted by block: first the block, then the anchors that come to it, in slices."""

    def score(batches):
        block = None
        for batch in batches:
            kinds = batch["anchor_id"].is_null().to_numpy(zero_copy_only=False)
            begin = 0
            while begin < batch.num_rows:
                if kinds[begin]:
                    block = Block({n: batch[n][begin].as_py() for n in ("ids", "labels", "vectors", "kind")}, order)
                    begin += 1
                    continue
                end = begin + max(1, CELLS // max(1, len(block.ids)))
                end = min(end, batch.num_rows, *(begin + np.flatnonzero(kinds[begin:end])[:1]))
                part = batch.slice(begin, end - begin)
                q = matrix(part["v"], len(order))[:, order]
                yield pa.RecordBatch.from_pydict(best(block, part["anchor_id"].to_numpy(), part["label"].to_numpy(), q, part["asked"].to_pylist(), same, k))
                begin = end

    return score


class _Space:
    """All rows in blocks, and the anchors with mean and spread of their scores against all rows."""

    def __init__(self, embeddings: DataFrame, every: int, scale: int, relabel):
        rows = usable(embeddings, scale)
        if relabel is not None:
            rows = rows.withColumn("label", relabel)
        one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row")).select("vec_id", "row.label", "row.v")
        one = stored(one, "negatives-rows")
        self.rows, width, labels = one.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.approx_count_distinct("label")).first()
        self.labels = max(1, labels)
        parallel = one.sparkSession.sparkContext.defaultParallelism
        block_rows = min(1 << 17, max(1024, self.rows // (4 * parallel)))
        packed = stored(one.mapInArrow(_packer(block_rows), PACKED).withColumn("_at", F.monotonically_increasing_id()), "negatives-packed")
        # One short row per block.
        places = packed.select("_at", (F.row_number().over(Window.orderBy("_at")) - 1).alias("block"))
        self.blocks = stored(packed.join(places, "_at").drop("_at"), "negatives-blocks")
        self.count = self.blocks.count()
        moments = self.blocks.select(F.posexplode(F.arrays_zip("sums", "squares")).alias("dim", "m")).groupBy("dim").agg(F.sum("m.sums"), F.sum("m.squares")).collect()
        mean, square = np.zeros(width), np.zeros(width)
        for dim, a, b in moments:
            mean[dim], square[dim] = a / self.rows, b / self.rows
        self.order = np.argsort(-square, kind="stable")
        spread = np.maximum(square - mean * mean, 0)

        def measured(batches):
            for batch in batches:
                q = matrix(batch["v"], width).astype(np.float64)
                more = {"mean": pa.array(q @ mean), "dev": pa.array(np.sqrt((q * q) @ spread) + 1e-9)}
                yield pa.RecordBatch.from_pydict({**{n: batch[n] for n in batch.schema.names}, **more})

        anchors = one.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "anchor_id")
        self.anchors = stored(anchors.mapInArrow(measured, "anchor_id bigint, label bigint, v array<bigint>, mean double, dev double"), "negatives-anchors")

    def search(self, requests: DataFrame, same: bool, k: int, rounds: int = 4) -> DataFrame:
        """anchor_id, key, other_id, score, rank: the first k rows of each request (anchor_id, key, lo, hi) by falling
        score among rows of the anchor's label (``same``) or of other labels."""
        rows = self.rows / self.labels if same else self.rows
        started = requests.join(self.anchors.select("anchor_id", "mean", "dev"), "anchor_id").mapInArrow(_starter(rows, 3 * k), "anchor_id bigint, key bigint, lo bigint, hi bigint, dev double, t bigint")
        waiting, done = stored(started, "negatives-asked"), None
        for turn in range(rounds + 1):
            if turn == rounds:
                waiting = waiting.withColumn("t", F.col("lo"))
            asked = waiting.groupBy("anchor_id").agg(F.collect_list(F.struct("key", "t", "hi")).alias("asked"))
            coming = asked.join(self.anchors.select("anchor_id", "label", "v"), "anchor_id")
            coming = coming.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(0, self.count - 1)))))
            met = self.blocks.drop("sums", "squares").unionByName(coming, allowMissingColumns=True)
            met = met.repartition("block").sortWithinPartitions("block", F.col("anchor_id").asc_nulls_first())
            found = met.mapInArrow(_scorer(self.order, same, k), "anchor_id bigint, key bigint, other_id bigint, score bigint")
            place = F.row_number().over(Window.partitionBy("anchor_id", "key").orderBy(F.desc("score"), "other_id"))
            found = stored(found.withColumn("rank", place).where(F.col("rank") <= k), "negatives-found")
            full = waiting.join(found.groupBy("anchor_id", "key").agg(F.count("*").alias("n")), ["anchor_id", "key"], "left")
            short = (F.coalesce("n", F.lit(0)) < k) & (F.col("t") > F.col("lo"))
            lower = F.greatest(F.col("lo"), F.col("t") - F.ceil(F.col("dev") * 4.0**turn / 2) - 1)
            again = stored(full.where(short).select("anchor_id", "key", "lo", "hi", "dev", lower.alias("t")), "negatives-asked")
            kept = found.join(again.select("anchor_id", "key"), ["anchor_id", "key"], "left_anti")
            done = kept if done is None else done.union(kept)
            if again.isEmpty():
                break
            waiting = again
        return done


def _starter(rows: float, expected: int):
    """Adds ``t``: where about ``expected`` of ``rows`` normally distributed scores lie between it and ``hi``."""

    def start(batches):
        for batch in batches:
            t = []
            for lo, hi, mean, dev in zip(*(batch[n].to_pylist() for n in ("lo", "hi", "mean", "dev"))):
                scores = NormalDist(mean, dev)
                share = scores.cdf(hi) - expected / max(rows, 1)
                t.append(max(lo, int(scores.inv_cdf(share))) if 0 < share < 1 else lo)
            kept = ("anchor_id", "key", "lo", "hi", "dev")
            yield pa.RecordBatch.from_pydict({**{n: batch[n] for n in kept}, "t": pa.array(t, pa.int64())})

    return start


def share_of(score: Column, percent: int, up: bool) -> Column:
    """percent * score / 100 as a whole number, rounded down or up, without leaving long for scores up to 2^62."""
    rest = F.pmod(score, F.lit(100))
    whole = F.call_function("div", score - rest, F.lit(100))
    part = percent * rest
    return percent * whole + F.call_function("div", part + (99 if up else 0), F.lit(100))


def mine(
    embeddings: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90),
    scale: int = 256, relabel: Column | None = None,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose vec_id is divisible by ``every``; each takes its first ``positives`` rows of its label, and for each of
    them the first ``negatives`` rows of other labels whose score is from window[0] to window[1] percent of the positive's.
    ``relabel`` replaces labels first.
    """
    space = _Space(embeddings.select("vec_id", "label", "embedding"), every, scale, relabel)
    asked = space.anchors.select("anchor_id", F.lit(0).cast("bigint").alias("key"), F.lit(LOWEST).alias("lo"), F.lit(HIGHEST).alias("hi"))
    chosen = space.search(asked, True, positives).select("anchor_id", F.col("other_id").alias("key"), F.col("score").alias("positive_score"))
    chosen = stored(chosen, "negatives-positives")
    low, high = share_of(F.col("positive_score"), window[0], True), share_of(F.col("positive_score"), window[1], False)
    asked = chosen.select("anchor_id", "key", low.alias("lo"), high.alias("hi")).where("lo <= hi")
    found = space.search(asked, False, negatives).join(chosen, ["anchor_id", "key"])
    return found.select(
        "anchor_id", F.col("key").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def shifted_label() -> Column:
    """Labels of rows with a vec_id divisible by 7 move on by one of ten."""
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


SQL = """
    WITH e AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    ), s AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
        FROM e AS a JOIN e AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
    ), p AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place FROM s WHERE same) WHERE place <= 5
    ), n AS (
        SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS place
        FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score
    )
    SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE place <= 10
    """

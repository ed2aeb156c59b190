"""Alignment of two tokenizers' tokens by merge-path partitioning.

Every text is encoded twice, and both encodings spell the same bytes. Ends of A tokens and of B tokens are two sorted lists;
merging them finds all overlaps: each stretch between two successive ends lies in one token of each. The merge is cut into
pieces of equal work by diagonals: for each, a binary search finds how many of its first ends come from A. Pieces are merged
independently and emit overlaps; a group (up to where both tokenizers end a token) that a cut divides is stitched when pieces are put together.
Texts follow each other in one stream, which every text's end divides like any group's.

Statistics of the whole corpus: how many overlaps (links) hold an A id and a B id linked. Texts are worked on in chunks of bounded size. A chunk
keeps its distinct id pairs with counts once; texts point to them. Counts add up over chunks by a shuffle of these pairs only, come
back per chunk, and texts read theirs from the chunk: links are never shuffled, and nothing is broadcast.

Null and empty texts, and texts whose tokens do not spell a space and the text (normalised ones), have no tokens: zeros and an empty string. Repeated
rows, shared and null doc_ids give a row each and count each. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from goldseam.llm.common import by_bytes, stored

# How texts are cut into words before byte-level merges.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "▁"


def _separated(tokens: int, mark: str) -> np.ndarray:
    return np.array([f"{k}{mark}" for k in range(tokens)], object)


class Pair:
    """Two encoders, and the bytes of their tokens.

    ``ranks`` is the byte-level vocabulary as ranks, ``merges`` the same as a tokenizer file, which encodes the texts that the faster
    encoder gives up on, and ``pieces`` the model of B.
    """

    def __init__(self, ranks: bytes, merges: bytes, pieces: bytes):
        import sentencepiece
        import tiktoken

        tokens = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self.merges = merges
        self.fast = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=tokens, special_tokens={})
        self.a_bytes = np.full(max(tokens.values()) + 1, b"", object)
        for token, rank in tokens.items():
            self.a_bytes[rank] = token
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        names = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = np.array([bytes([int(n[1:-1], 16)]) if self.b.is_byte(k) else n.replace(SPACE, " ").encode() for k, n in enumerate(names)], object)
        self.a_size, self.b_size = (np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.a_next, self.a_last = _separated(len(self.a_bytes), ","), _separated(len(self.a_bytes), "|")
        self.b_next, self.b_last = _separated(len(self.b_bytes), ","), _separated(len(self.b_bytes), ";")

    @functools.cached_property
    def _slow(self):
        from tokenizers import Tokenizer

        slow = Tokenizer.from_str(self.merges.decode())
        slow.encode_special_tokens = True
        return slow

    def encode_a(self, text: str) -> np.ndarray:
        try:
            return np.array(self.fast.encode_ordinary(text), np.int64)
        except BaseException as error:  # a panic of its regular expressions is no Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.int64)

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """A and B ids of each text; none where they do not spell it."""
        none = np.zeros(0, np.int64)
        made = []
        for text in texts:
            a = b = none
            if text:
                a, b = self.encode_a(" " + text), np.array(self.b.encode(text, num_threads=1), np.int64)
                whole = b" " + text.encode()
                if b"".join(self.a_bytes[a]) != whole or b"".join(self.b_bytes[b]) != whole:
                    a = b = none
            made.append((a, b))
        return made


@functools.lru_cache(maxsize=1)
def pair(ranks: bytes, merges: bytes, pieces: bytes) -> Pair:
    return Pair(ranks, merges, pieces)


def contents(files: tuple[str, str, str]) -> tuple[bytes, ...]:
    """The vocabularies (some megabytes, whatever the corpus), read where the driver runs."""
    return tuple(Path(f).read_bytes() for f in files)


def cuts(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of a and of b lie before each cut of their merge into pieces of ``work`` (equal ends: a first)."""
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (low < high).any():
        open_ = low < high
        at = (low + high) // 2
        # Take one more of a if it comes before the last that is taken of b.
        more = np.zeros(len(at), bool)
        more[open_] = a[at[open_]] <= b[diagonal[open_] - at[open_] - 1]
        low, high = np.where(open_ & more, at + 1, low), np.where(open_ & ~more, at, high)
    return low, diagonal - low


def merged_piece(a: np.ndarray, b: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Overlaps of one piece: places in a and b (counted from the piece's), whether both end there, and whether its first end
    was the last of the piece before (whose overlap then ends in both)."""
    ends = np.unique(np.concatenate([a, b]))
    again = len(ends) > 0 and ends[0] == before
    if again:
        ends = ends[1:]
    in_a, in_b = np.searchsorted(a, ends), np.searchsorted(b, ends)
    both = np.zeros(len(ends), bool)
    inside = (in_a < len(a)) & (in_b < len(b))
    both[inside] = a[in_a[inside]] == b[in_b[inside]]
    return in_a, in_b, both, again


def overlaps(a: np.ndarray, b: np.ndarray, work: int = 1 << 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For ends of A and B tokens: A token and B token of each overlap in order, and whether a group closes with it."""
    i, j = cuts(a, b, work)
    made: list[tuple] = []
    for k in range(len(i) - 1):
        before = max(a[i[k] - 1] if i[k] else 0, b[j[k] - 1] if j[k] else 0)
        in_a, in_b, both, again = merged_piece(a[i[k] : i[k + 1]], b[j[k] : j[k + 1]], before)
        if again and k:
            # A piece of one end may have given none, so the overlap is that of the last piece with any.
            last = next(m for m in reversed(made) if len(m[2]))
            last[2][-1] = True
        made.append((in_a + i[k], in_b + j[k], both))
    if not made:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)
    return tuple(np.concatenate(part) for part in zip(*made))


class Aligned:
    """The texts of one slice, aligned: per text counts, groups as text, and its distinct id pairs with their counts."""

    def __init__(self, texts: list[str | None], p: Pair, work: int = 1 << 16):
        ids = p.encode(texts)
        docs = len(ids)
        self.n_a, self.n_b = (np.array([len(x[k]) for x in ids], np.int64) for k in (0, 1))
        a_ids, b_ids = (np.concatenate([np.zeros(0, np.int64), *(x[k] for x in ids)]) for k in (0, 1))
        a, b = np.cumsum(p.a_size[a_ids]), np.cumsum(p.b_size[b_ids])
        link_a, link_b, closed = overlaps(a, b, work)
        doc = np.repeat(np.arange(docs), self.n_a)[link_a]
        self.n_links = np.bincount(doc, minlength=docs)
        self.n_groups = np.bincount(doc[closed], minlength=docs)
        self.groups = self._texts(p, a_ids, b_ids, a, b, a[link_a[closed]])
        # Id pairs of each text, as one number: text, A id, B id.
        self.b_span = len(p.b_bytes)
        span = len(p.a_bytes) * self.b_span
        codes, times = np.unique(doc * span + a_ids[link_a] * self.b_span + b_ids[link_b], return_counts=True)
        at = np.searchsorted(codes, np.arange(docs + 1) * span)
        self.pairs = [(codes[s:e] - k * span, times[s:e]) for k, (s, e) in enumerate(zip(at[:-1], at[1:]))]

    def _texts(self, p: Pair, a_ids, b_ids, a, b, closing) -> list[str]:
        """``a1,a2|b1;a3|b2`` of each text."""
        group_a, group_b = np.searchsorted(closing, a), np.searchsorted(closing, b)
        last_a, last_b = (np.append(g[1:] != g[:-1], True)[: len(g)] for g in (group_a, group_b))
        made = np.empty(len(a) + len(b), object)
        made[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = np.where(last_a, p.a_last[a_ids], p.a_next[a_ids])
        made[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = np.where(last_b, p.b_last[b_ids], p.b_next[b_ids])
        at = np.append(0, np.cumsum(self.n_a + self.n_b))
        return ["".join(made[s:e])[:-1] for s, e in zip(at[:-1], at[1:])]


COUNTS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
POINTED = "chunk bigint, steps array<int>, times array<int>, pairs array<bigint>"


def _aligner(shared, slice_bytes: int, chunk_bytes: int, texts: bool, kind: pa.DataType):
    """Rows of texts, and after those of a chunk one row with its distinct pairs and how often each occurs."""

    def closed(rows: list, chunk: int):
        keys = np.concatenate([np.zeros(0, np.int64), *(k for r in rows for k, _ in r["pairs"])])
        times = np.concatenate([np.zeros(0, np.int64), *(t for r in rows for _, t in r["pairs"])])
        distinct, place = np.unique(keys, return_inverse=True)
        begin = 0
        for r in rows:
            # A text's pairs go by place, kept as steps from one to the next.
            steps = []
            for k, _ in r["pairs"]:
                steps.append(np.diff(place[begin : begin + len(k)], prepend=0))
                begin += len(k)
            n = len(r["pairs"])
            columns = {
                "doc_id": r["doc_id"], "n_a": pa.array(r["n_a"]), "n_b": pa.array(r["n_b"]), "n_groups": pa.array(r["n_groups"]), "n_links": pa.array(r["n_links"]),
                "groups_sha256": pa.array(r["digests"], pa.string()),
                "chunk": pa.array([chunk] * n, pa.int64()), "steps": pa.array(steps, pa.list_(pa.int32())),
                "times": pa.array([t for _, t in r["pairs"]], pa.list_(pa.int32())), "pairs": pa.nulls(n, pa.list_(pa.int64())),
            }
            if texts:
                columns["groups"] = pa.array(r["groups"], pa.string())
            yield pa.RecordBatch.from_pydict(columns)
        sums = np.zeros(len(distinct), np.int64)
        np.add.at(sums, place, times)
        last = {"chunk": pa.array([chunk]), "pairs": pa.array([distinct], pa.list_(pa.int64())), "times": pa.array([sums], pa.list_(pa.int32()))}
        empty = {"doc_id": kind, **{n: pa.int64() for n in ("n_a", "n_b", "n_groups", "n_links")}, "groups_sha256": pa.string(), "steps": pa.list_(pa.int32())}
        if texts:
            empty["groups"] = pa.string()
        last |= {n: pa.nulls(1, t) for n, t in empty.items()}
        yield pa.RecordBatch.from_pydict({n: last[n] for n in (list(columns) if rows else last)})

    def align(batches):
        p = pair(*shared.value)
        chunk = TaskContext.get().partitionId() << 32
        rows, size = [], 0
        for part in by_bytes(batches, "text", slice_bytes):
            made = Aligned(part["text"].to_pylist(), p)
            row = {"doc_id": part["doc_id"], **{n: getattr(made, n) for n in ("n_a", "n_b", "n_groups", "n_links", "pairs")}}
            row["digests"] = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in made.groups]
            if texts:
                row["groups"] = made.groups
            rows.append(row)
            size += part["text"].nbytes
            if size >= chunk_bytes:
                yield from closed(rows, chunk)
                chunk, rows, size = chunk + 1, [], 0
        if rows:
            yield from closed(rows, chunk)

    return align


def _reader(kind: pa.DataType):
    """Rows sorted by chunk, its pairs' facts before its texts: per text how many links are their B id's most frequent, and the sum of counts."""

    def read(batches):
        chunk, parts, facts = None, [], None
        for batch in batches:
            of_text = batch["at"].is_null().to_numpy(zero_copy_only=False)
            chunks = batch["chunk"].to_numpy()
            edges = np.flatnonzero((of_text[1:] != of_text[:-1]) | (chunks[1:] != chunks[:-1])) + 1
            for s, e in zip([0, *edges], [*edges, batch.num_rows]):
                if e == s:
                    continue
                part = batch.slice(s, e - s)
                if chunks[s] != chunk:
                    chunk, parts, facts = chunks[s], [], None
                if not of_text[s]:
                    parts.append((part["n"].to_numpy(), part["best"].to_numpy(zero_copy_only=False)))
                    continue
                if facts is None:
                    facts = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64), np.zeros(0, bool)]
                best, total = [], []
                for steps, times in zip(part["steps"], part["times"]):
                    at, times = np.cumsum(steps.values.to_numpy()), times.values.to_numpy().astype(np.int64)
                    best.append(int(times[facts[1][at]].sum()) if len(at) else 0)
                    total.append(int((times * facts[0][at]).sum()) if len(at) else 0)
                kept = {n: part[n] for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
                more = {"n_best": pa.array(best, pa.int64()), "count_sum": pa.array(total, pa.int64()), "groups_sha256": part["groups_sha256"]}
                yield pa.RecordBatch.from_pydict({**kept, **more})

    return read


def _aligned(docs: DataFrame, files: tuple[str, str, str], slice_bytes: int, chunk_bytes: int, texts: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType
    more = ", groups string" if texts else ""
    schema = f"doc_id {kind.simpleString()}, {COUNTS}, {POINTED}{more}"
    shared = docs.sparkSession.sparkContext.broadcast(contents(files))
    return docs.mapInArrow(_aligner(shared, slice_bytes, chunk_bytes, texts, to_arrow_type(kind)), schema)


def align(docs: DataFrame, files: tuple[str, str, str], slice_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, groups: ids of both tokenizers by groups, ``a1,a2|b1;a3|b2,b3``."""
    made = _aligned(docs, files, slice_bytes, slice_bytes, True).where("pairs IS NULL")
    return made.select("doc_id", *(c.split()[0] for c in COUNTS.split(", ")), "groups")


def statistics(docs: DataFrame, files: tuple[str, str, str], slice_bytes: int = 2 << 20, chunk_bytes: int = 12 << 20) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    Bounds, none of which changes results: texts of ``slice_bytes`` are aligned at once, and texts of ``chunk_bytes`` share a list of pairs.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    made = stored(_aligned(docs, files, slice_bytes, chunk_bytes, False), "crosstoken-aligned")
    chunks = made.where(F.col("pairs").isNotNull())
    listed = chunks.select("chunk", F.posexplode(F.arrays_zip("pairs", "times")).alias("at", "p")).select("chunk", "at", F.col("p.pairs").alias("pair"), "p.times")
    counts = listed.groupBy("pair").agg(F.sum("times").alias("n"))
    span = pair(*contents(files)).b_bytes.size
    # A B id has at most as many rows here as A has ids.
    highest = F.max("n").over(Window.partitionBy(F.col("pair") % span))
    counts = counts.withColumn("best", F.col("n") == highest)
    facts = listed.drop("times").join(counts, "pair").select("chunk", "at", "n", "best")
    of_texts = made.where(F.col("pairs").isNull()).drop("pairs")
    met = facts.unionByName(of_texts, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", F.col("at").asc_nulls_last())
    kind = docs.schema["doc_id"].dataType
    schema = f"doc_id {kind.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return met.mapInArrow(_reader(to_arrow_type(kind)), schema)

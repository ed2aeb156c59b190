"""Exact self-join on the Jaccard similarity of word shingles, by pivots in metric space.

1 - Jaccard is a metric. Copies (equal sets) become one class. Any two linked classes share a shingle among the first
k = n - ceil(threshold n) + 1 of each, in any order of shingles common to all, so classes that share one
form a first region; nothing links across. In the order used, shingles common among classes come last, so
that frequent lines and passages make no regions of their own.

A region of at most DIRECT classes is compared directly. A larger one takes a pivot: the class that shares most shingles,
the likely original of a group of near copies. Regions with the same pivot are one cell, so each member is
measured once per pivot. Members up to distance BALL belong to the pivot; all others go on to the region's next pivot, so that
the pivots divide a region like Voronoi cells in the order of the pivots. By the triangle inequality any partner of a member
within the ball lies within BALL plus the radius: documents of that window are replicated to both.

Inside a ball a member is coded by its difference from the pivot (shingles in only one of the two). Members linked to the
pivot are connected. Of any other pair at least one is not linked to it, and then the triangle inequality for symmetric differences
says that the two share differences, so many that the rarest of each hold a common one. Few members
with a common rare difference are compared by differences; many are a smaller region with a pivot of their own: regions join recursively.
What is left after ROUNDS rounds, and regions that became small, are compared directly.

Direct comparison leaves out what cannot connect anything: pairs connected already, of sizes that cannot be linked, or
whose sketches (parities of shingles in
SKETCH_BITS buckets, in which shared shingles cancel out) differ in more places than linked sets do. In regions of light
shingles it counts the regions where two classes meet instead, since linked classes must meet in many.

Results are components: class members, connected by links, by smallest doc_id. Links are decided on 64-bit hashes of
shingles.

Texts without words, and null texts, have empty sets and are linked with nothing. Repeated rows are copies. A null
doc_id is never the smallest unless a component has no other.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from goldseam.llm.common import by_bytes, salted_join, sieved, stored, trimmed

#: A shingle of more classes is common. A region of up to DIRECT classes is compared without pivots.
LEAF, DIRECT = 32, 32
#: Regions that rounds of pivots leave are compared directly up to LATER times that size, as sketches go first there.
LATER = 16
#: Distance up to which a document belongs to a region's pivot, and rounds of pivots before what is left is compared directly.
BALL, ROUNDS = 0.4, 2
SKETCH_BITS = 512
#: Bytes of text that a Python worker turns into sets at a time (a longer text is one slice).
SLICE_BYTES = 1 << 20
SKETCH = [f"sketch{k}" for k in range(SKETCH_BITS // 64)]
_LEFT, _RIGHT = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _WordHashes(dict):
    """64-bit hash of each word met; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 100_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _LEFT
    h = (h ^ (h >> np.uint64(27))) * _RIGHT
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes | None, hashes: dict, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all windows of ``size`` words; of the whole sequence if there are fewer."""
    words = (text or b"").lower().split()  # on bytes, both know ASCII only
    if not words:
        return np.zeros(0, np.int64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    made = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        made = _mix(made + codes[k : len(codes) - width + 1 + k])
    return np.unique(made.view(np.int64))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def posted_length(n: int, percent: int) -> int:
    """Shingles posted at first: the prefix, and some more in case common ones have to go to the end."""
    k = prefix_length(n, percent)
    return min(n, k + 8 + k // 8)


def sketch(codes: np.ndarray) -> np.ndarray:
    """Parities of the number of shingles per bucket, as 64-bit integers. Two sets' sketches differ in at most as
    many bits as there are shingles in only one of the sets."""
    odd = np.bincount(codes & (SKETCH_BITS - 1), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(docs: DataFrame, schema: str, percent: int, whole: bool) -> DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]

    def mapped(batches):
        hashes = _WordHashes()
        for part in by_bytes(batches, "text", SLICE_BYTES):
            sets = [shingles(text, hashes) for text in part["text"].to_pylist()]
            columns = {
                "doc_id": part["doc_id"],
                "digest": part["digest"],
                "cid": pa.array([np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64)) for s in sets], pa.int64()),
                "n": pa.array([len(s) for s in sets], pa.int32()),
                "codes": pa.array([s if whole else s[: posted_length(len(s), percent)] if len(s) else s for s in sets], pa.list_(pa.int64())),
            }
            if whole:
                made = np.array([sketch(s) for s in sets], np.int64).reshape(len(sets), len(SKETCH))
                columns |= {n: pa.array(made[:, k]) for k, n in enumerate(SKETCH)}
            yield pa.RecordBatch.from_pydict({n: columns[n] for n in names})

    digest = (text_digest() if "digest" in names else F.lit(None).cast("binary")).alias("digest")
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"), digest).mapInArrow(trimmed(mapped), schema)


def text_digest(text: str = "text") -> Column:
    """128 bits that tell texts apart; those of an empty one for null."""
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("binary"), F.lit(b""))))


def _k(n: Column, percent: int) -> Column:
    return (n - F.ceil(F.lit(percent) * n / 100) + 1).cast("int")


def _compatible(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be linked at all."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, both (shared shingles), n_a, n_b of pairs of classes. A class may be in any number of pairs:
    both joins are of two plain shuffles, which adaptive execution splits where a class is hot."""
    left = sets.select(F.col("cid").alias("a"), F.col("codes").alias("codes_a"))
    right = sets.select(F.col("cid").alias("b"), F.col("codes").alias("codes_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.select(
        "a", "b", F.size(F.array_intersect("codes_a", "codes_b")).alias("both"), F.size("codes_a").alias("n_a"), F.size("codes_b").alias("n_b")
    )


def _union(n_a: str = "n_a", n_b: str = "n_b") -> Column:
    return F.col(n_a) + F.col(n_b) - F.col("both")


def connected(links: DataFrame) -> DataFrame:
    """cid, label: the smallest class id reachable by links (a, b), of every class that has one.

    Every round, each class takes the smallest label around it, then the label of its label. The joins are
    of stored tables, so adaptive execution splits classes with many links and labels of many classes.
    """
    edges = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = stored(edges, "jaccard-edges")
    labels = stored(edges.groupBy(F.col("a").alias("cid")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "jaccard-labels")
    while True:
        around = edges.join(labels.withColumnRenamed("cid", "b"), "b").groupBy(F.col("a").alias("cid")).agg(F.min("label").alias("near"))
        taken = labels.join(around, "cid").select("cid", F.col("label").alias("before"), F.least("label", "near").alias("next"))
        taken = stored(taken, "jaccard-labels")
        ahead = taken.select(F.col("cid").alias("next"), F.col("next").alias("jump"))
        labels = taken.join(ahead, "next").select("cid", "before", F.least("next", "jump").alias("label"))
        labels = stored(labels, "jaccard-labels")
        if labels.where(F.col("before") != F.col("label")).isEmpty():
            return labels.select("cid", "label")
        labels = labels.select("cid", "label")


def _labelled(regions: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Regions with more than one label among their members, labels brought up to date."""
    regions = regions.drop("label")
    if labels is None:
        regions = regions.withColumn("label", F.col("cid"))
    else:
        regions = regions.join(labels, "cid", "left")
        regions = regions.withColumn("label", F.coalesce("label", "cid"))
    # Size and labels of a region combine in the map tasks.
    facts = regions.groupBy("region").agg(
        F.count("*").alias("size"), F.min("label").alias("_low"), F.max("label").alias("_high"), F.max(F.struct("central", "cid"))["cid"].alias("centre")
    )
    facts = stored(facts.where(F.col("_low") != F.col("_high")).drop("_low", "_high"), "jaccard-facts")
    return salted_join(regions, facts, "region", "size", F.xxhash64("cid"))


def _met_pairs(members: DataFrame, percent: int) -> DataFrame:
    """a, b, shared: pairs of members of a region that may still connect something, and in how many regions they meet."""
    left = members.select("region", F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("label").alias("l_a"))
    right = members.select("region", F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("label").alias("l_b"))
    meet = (F.col("a") < F.col("b")) & (F.col("l_a") != F.col("l_b")) & _compatible(F.col("n_a"), F.col("n_b"), percent)
    return left.join(right, "region").where(meet).groupBy("a", "b").agg(F.count("*").alias("shared"))


def _sketches_meet(percent: int) -> Column:
    """Whether sketches and sizes (of sides a and b) leave a link possible: linked sets have at most this share of their
    shingles in one of them only."""
    differ = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in SKETCH), F.lit(0))
    return (100 + percent) * differ <= (100 - percent) * (F.col("n_a") + F.col("n_b"))


def _sketched(pairs: DataFrame, codes: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes whose sketches leave a link possible, before whole sets are moved for them."""
    for side in "ab":
        own = (F.col(c).alias(f"{c}_{side}") for c in SKETCH)
        pairs = pairs.join(codes.select(F.col("cid").alias(side), F.size("codes").alias(f"n_{side}"), *own), side)
    return stored(pairs.where(_sketches_meet(percent)).select("a", "b"), "jaccard-pairs")


def _close_pairs(members: DataFrame, codes: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of members of a region that may still connect something, by size and sketch.

    All of that is a condition of the join, so that pairs it excludes are never rows.
    """
    members = members.join(codes.select("cid", *SKETCH), "cid")
    columns = ["cid", "n", "label", *SKETCH]
    left, right = (members.select("region", *(F.col(c).alias(f"{c}_{side}") for c in columns)) for side in "ab")
    meet = (
        (F.col("cid_a") < F.col("cid_b")) & (F.col("label_a") != F.col("label_b")) & _compatible(F.col("n_a"), F.col("n_b"), percent)
        & _sketches_meet(percent)
    )
    return left.join(right, "region").where(meet).select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b")).distinct()


def _measured(cells: DataFrame, codes: DataFrame) -> DataFrame:
    """pivot, cid, n, n_p, diff (what is in only one of the two sets) of every cell. A member's list is read once per
    pivot, and both joins are of plain shuffles, which adaptive execution splits where a pivot is hot."""
    own = codes.select("cid", "codes")
    pivots = own.join(cells.select(F.col("pivot").alias("cid")).distinct(), "cid", "left_semi")
    met = cells.join(own, "cid").join(pivots.select(F.col("cid").alias("pivot"), F.col("codes").alias("codes_p")), "pivot")
    diff = F.concat(F.array_except("codes", "codes_p"), F.array_except("codes_p", "codes"))
    return met.select("pivot", "cid", F.size("codes").alias("n"), F.size("codes_p").alias("n_p"), diff.alias("diff"))


def _distance() -> Column:
    """Jaccard distance of a measured member to its pivot."""
    return 2 * F.size("diff") / (F.col("n") + F.col("n_p") + F.size("diff"))


def _near(percent: int) -> Column:
    """Whether a measured member is linked to its pivot."""
    return (100 + percent) * F.size("diff") <= (100 - percent) * (F.col("n") + F.col("n_p"))


def _entries(cells: DataFrame, percent: int) -> DataFrame:
    """key (pivot and difference), member and place of the differences by which members of a cell find their partners.

    Of two members that are not connected, one (b) is not linked to the pivot, so |b - p| exceeds what links them, and a
    link of a and b needs more than (share of |a - p|) / 2 common differences: a's first ones in any common order hold
    one. Differences that no member far from the pivot has, or only one member, come first and join nothing.
    """
    keyed = F.xxhash64("pivot", "d").alias("key")
    each = cells.select("pivot", "cid", "n", "n_p", "label", "linked", F.size("diff").alias("size_d"), F.explode("diff").alias("d"))
    each = each.withColumn("key", keyed).drop("d")
    often = each.groupBy("key").agg(F.count("*").alias("m"), F.sum((~F.col("linked")).cast("long")).alias("open"))
    often = stored(often.where("m > 1 AND open > 0"), "jaccard-often")
    met = salted_join(each, often, "key", "m", F.xxhash64("cid"))
    member = ["pivot", "cid", "n", "n_p", "label", "linked", "size_d"]
    met = met.groupBy(*member).agg(F.array_sort(F.collect_list(F.struct("open", "key"))).alias("shared"))
    both, less = F.lit(2 * (100 + percent)), F.lit(100 - percent)
    # Common differences that a link with a member far from the pivot needs, and with one linked to it.
    far = F.floor(((100 + percent) * F.col("size_d") + less * (F.col("n_p") - F.col("n"))) / both) + 1
    close = F.floor(((100 + percent) * F.col("size_d") - less * (F.col("n_p") + F.col("n"))) / both) + 1
    needs = F.when(F.col("linked"), far).otherwise(F.least(far, close))
    skipped = F.col("size_d") - F.size("shared")
    taken = F.greatest(F.col("size_d") - needs + 1 - skipped, F.lit(0)).cast("int")
    met = met.withColumn("skipped", skipped).withColumn("central", F.when(F.col("linked"), 0).otherwise(1) + F.size("shared") / F.col("size_d"))
    met = met.select(*member, "skipped", "central", F.posexplode(F.slice("shared", F.lit(1), taken)).alias("at", "x"))
    return met.select(*member, "central", "x.key", (F.col("skipped") + F.col("at")).alias("at"))


def _partners(few: DataFrame, percent: int) -> DataFrame:
    """pivot, a, b: pairs under a key whose members far from the pivot are at most DIRECT, where the place of the key
    leaves enough differences to share. The triangle inequality between both distances is part of it."""
    columns = ["cid", "n", "label", "linked", "size_d", "at"]
    left = few.where("NOT linked").select("key", "pivot", "size", *(F.col(c).alias(f"{c}_b") for c in columns))
    right = few.select("key", *(F.col(c).alias(f"{c}_a") for c in columns))
    met = salted_join(right, left, "key", "size", F.xxhash64("cid_a"))
    needs = (100 + percent) * (F.col("size_d_a") + F.col("size_d_b")) - (100 - percent) * (F.col("n_a") + F.col("n_b"))
    left_over = F.least(F.col("size_d_a") - F.col("at_a"), F.col("size_d_b") - F.col("at_b"))
    meet = (
        (F.col("label_a") != F.col("label_b")) & (F.col("linked_a") | (F.col("cid_a") < F.col("cid_b")))
        & _compatible(F.col("n_a"), F.col("n_b"), percent) & (2 * (100 + percent) * left_over >= needs)
    )
    pair = (F.least("cid_a", "cid_b").alias("a"), F.greatest("cid_a", "cid_b").alias("b"))
    return met.where(meet).groupBy(*pair).agg(F.min("pivot").alias("pivot"))


def _linked_by_differences(pairs: DataFrame, cells: DataFrame, percent: int) -> DataFrame:
    """Links among pairs of members of a cell, decided on their differences from its pivot."""
    for side in "ab":
        own = cells.select("pivot", F.col("cid").alias(side), F.col("n").alias(f"n_{side}"), F.col("diff").alias(f"diff_{side}"))
        pairs = pairs.join(own, ["pivot", side])
    apart = F.size("diff_a") + F.size("diff_b") - 2 * F.size(F.array_intersect("diff_a", "diff_b"))
    return pairs.where((100 + percent) * apart <= (100 - percent) * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _posted(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Shingles that two classes have posted, with their frequency; per class with any, its light and common ones
    and how many a prefix still misses without the common ones; and the postings."""
    posted = classes.select("cid", F.explode("codes").alias("s"))
    shared = stored(posted.groupBy("s").agg(F.count("*").alias("df")).where("df > 1"), "jaccard-shared")
    near = salted_join(posted, shared, "s", "df", F.col("cid"))
    k = _k(F.col("n"), percent)
    facts = classes.select("cid", "n", k.alias("k"), F.size("codes").alias("posted"), F.try_element_at("codes", F.lit(-1)).alias("last"))
    hits = near.groupBy("cid").agg(F.collect_list(F.struct("df", "s")).alias("hits")).join(facts, "cid")
    common = F.transform(F.filter("hits", lambda x: x["df"] > LEAF), lambda x: F.struct(_weight(x["df"]).alias("w"), x["s"].alias("s")))
    hits = (
        hits.withColumn("common", F.array_sort(common))
        .withColumn("light", F.transform(F.filter("hits", lambda x: x["df"] <= LEAF), lambda x: x["s"]))
        .withColumn("central", F.size("hits") / F.col("posted"))
        .withColumn("missing", F.greatest(F.col("k") - (F.col("posted") - F.size("common")), F.lit(0)))
        .withColumn("deep", (F.col("missing") > 0) & (F.col("posted") < F.col("n")))
        .drop("hits")
    )
    return shared, stored(hits, "jaccard-hits"), posted


def _weight(df: Column | str) -> Column:
    """Place of a common shingle in the order: after all light ones, rarer ones first."""
    return F.floor(F.log2(df)).cast("int")


def links(docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes that connect all linked classes (not every pair of a group)."""
    classes = stored(sets.where("n > 0").dropDuplicates(["cid"]).select("cid", "n", "codes"), "jaccard-classes")
    shared, hits, posted = _posted(classes, percent)
    needed = F.slice("common", 1, F.col("missing"))
    last = F.try_element_at(needed, F.lit(-1))
    # ``covered`` is how many shingles of the class come up to its end (w, s) in the order.
    plain = hits.where("NOT deep").select(
        "cid", "n", "central", "light", needed.alias("needed"),
        (F.col("posted") - F.size("common") + F.col("missing")).alias("covered"),
        F.coalesce(last["w"], F.lit(0)).alias("w"), F.coalesce(last["s"], "last").alias("s"),
    )
    entries = plain.select("cid", "n", "central", F.explode(F.concat("light", F.transform("needed", lambda x: x["s"]))).alias("region"))
    ends = plain.select("cid", "n", "covered", "w", "s")
    # Classes made of common shingles, but for less than a prefix, need an order of all of their shingles.
    heavy = stored(hits.where("missing > 0").select("cid", "n", "k", "central", "deep"), "jaccard-heavy")
    codes = None
    if not heavy.isEmpty():
        codes = _whole(docs, sets, heavy, percent)
        every = heavy.where("deep").join(codes.select("cid", "codes"), "cid").select("cid", "n", "k", "central", F.explode("codes").alias("s"))
        often = every.groupBy("s").agg(F.count("*").alias("m")).join(shared.where(F.col("df") > LEAF), "s", "left")
        ranked = salted_join(every, often, "s", "m", F.col("cid")).withColumn("w", F.coalesce(_weight("df"), F.lit(0)))
        order = Window.partitionBy("cid").orderBy("w", "s")  # a partition is one class
        first = ranked.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= F.col("k"))
        first = stored(first.select("cid", "n", "k", "central", "w", "s"), "jaccard-deep")
        end = first.groupBy("cid", "n", "k").agg(F.max(F.struct("w", "s")).alias("end"))
        ends = ends.union(end.select("cid", "n", F.col("k").alias("covered"), "end.w", "end.s"))
        entries = entries.unionByName(first.select("cid", "n", "central", F.col("s").alias("region")))
        # Plain classes may hold these shingles as the only ones to post them.
        new = _few(stored(first.select("s").distinct().join(shared, "s", "left_anti"), "jaccard-new"))
        alone = posted.join(new, "s", "left_semi").join(heavy.where("deep").select("cid"), "cid", "left_anti").join(classes.select("cid", "n"), "cid")
        entries = entries.unionByName(alone.select("cid", "n", F.lit(0.0).alias("central"), F.col("s").alias("region")))
    # Stored, as all postings are behind it and it is read more than once. An entry that came twice takes the larger share.
    entries = stored(entries.groupBy("region", "cid", "n").agg(F.max("central").alias("central")), "jaccard-entries")
    regions = stored(_labelled(entries, None), "jaccard-regions")
    found = None
    large = regions.where(F.col("size") > DIRECT)
    if not large.isEmpty():
        rest = large.select("cid").distinct()
        if codes is not None:
            rest = rest.join(codes.select("cid"), "cid", "left_anti")
        more = _whole(docs, sets, rest, percent)
        found = _large_regions(large, more if codes is None else codes.union(more), percent)
        regions = regions.where(F.col("size") <= DIRECT).drop("label").join(connected(found), "cid", "left")
        regions = regions.withColumn("label", F.coalesce("label", "cid"))
    pairs = _met_pairs(regions, percent)
    # Of the class whose end comes first, every covered shingle that the other has is one where the two
    # meet; so they share at most those and what it does not cover. Two that also meet in a large region,
    # which is not counted here, are settled: linked only if connected already.
    for side in ("a", "b"):
        pairs = pairs.join(ends.select(*(F.col(c).alias(side if c == "cid" else f"{c}_{side}") for c in ends.columns)), side)
    a_first = F.struct(F.col("w_a"), F.col("s_a")) <= F.struct(F.col("w_b"), F.col("s_b"))
    most = F.col("shared") + F.when(a_first, F.col("n_a") - F.col("covered_a")).otherwise(F.col("n_b") - F.col("covered_b"))
    possible = (100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))
    pairs = stored(pairs.where(possible).select("a", "b"), "jaccard-pairs")
    wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    codes = _whole(docs, sets, wanted, percent)
    close = _linked(compare(_sketched(pairs, codes, percent), codes), percent)
    return stored(close if found is None else found.union(close), "jaccard-links")


def _linked(compared: DataFrame, percent: int) -> DataFrame:
    return compared.where(100 * F.col("both") >= percent * _union()).select("a", "b")


def _large_regions(large: DataFrame, codes: DataFrame, percent: int) -> DataFrame:
    """Links that connect all linked members of regions of more than DIRECT classes, by rounds of pivots."""
    radius = 1 - percent / 100 + 1e-9  # rounding may not exclude a link
    found, labels = None, None
    for rounds in itertools.count():
        cells = large.where("cid <> centre").select(F.col("centre").alias("pivot"), "cid").distinct()
        measured = stored(_measured(cells, codes).withColumn("linked", _near(percent)).withColumn("d", _distance()), "jaccard-measured")
        close = measured.where("linked").select(F.col("cid").alias("a"), F.col("pivot").alias("b"))
        found = stored(close if found is None else found.union(close), "jaccard-links")
        if labels is None or not close.isEmpty():
            labels = connected(found)
        # Within the ball and its window, cells of several labels go on by differences.
        ball = measured.where(F.col("d") <= BALL + radius).join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
        facts = ball.groupBy("pivot").agg(F.count("*").alias("size"), F.min("label").alias("_low"), F.max("label").alias("_high"))
        facts = facts.where("_low <> _high").select("pivot", "size")
        ball = stored(salted_join(ball, facts, "pivot", "size", F.xxhash64("cid")).drop("size"), "jaccard-cells")
        entries = stored(_entries(ball, percent), "jaccard-entries")
        facts = entries.groupBy("key").agg(
            F.count("*").alias("size"), F.sum((~F.col("linked")).cast("long")).alias("open"), F.min("label").alias("_low"), F.max("label").alias("_high")
        )
        facts = facts.where("_low <> _high AND open > 0").drop("_low", "_high")
        entries = stored(salted_join(entries, facts, "key", "size", F.xxhash64("cid")), "jaccard-entries")
        pairs = stored(_partners(entries.where(F.col("open") <= DIRECT), percent), "jaccard-pairs")
        more = stored(_linked_by_differences(pairs, ball, percent), "jaccard-links")
        found = found.union(more)
        # Common differences make smaller regions; members beyond the ball go on with another pivot.
        columns = ["region", "cid", "n", "central"]
        inner = entries.where(F.col("open") > DIRECT).select(F.col("key").alias("region"), *columns[1:])
        beyond = measured.where(F.col("d") > BALL).select(F.col("pivot").alias("centre"), "cid")
        outer = large.join(beyond, ["centre", "cid"]).select(*columns)
        left = inner.union(outer)
        if left.isEmpty():
            return found
        if not more.isEmpty():
            labels = connected(found)
        large = stored(_labelled(left, labels), "jaccard-regions")
        direct = F.lit(rounds + 1 >= ROUNDS) | (F.col("size") <= LATER * DIRECT)
        pairs = stored(_close_pairs(large.where(direct), codes, percent), "jaccard-pairs")
        more = stored(_linked(compare(pairs, codes), percent), "jaccard-links")
        if not more.isEmpty():
            found, labels = found.union(more), None
        large = large.where(~direct)
        if large.isEmpty():
            return found


def _few(keys: DataFrame, broadcast_rows: int = 500_000) -> DataFrame:
    """``keys`` (a stored column of 8 bytes), broadcast if there are at most ``broadcast_rows``."""
    return F.broadcast(keys) if keys.limit(broadcast_rows + 1).count() <= broadcast_rows else keys


def _whole(docs: DataFrame, sets: DataFrame, wanted: DataFrame, percent: int, broadcast_rows: int = 500_000) -> DataFrame:
    """cid, codes (all shingles) and sketch of the wanted classes, made again from one document of each.

    One document's id per class is broadcast if there are at most ``broadcast_rows`` (8 bytes
    each); otherwise the texts are joined by a shuffle. Classes of documents without an id come from all of those.
    """
    one = wanted.select("cid").join(sets.groupBy("cid").agg(F.min("doc_id").alias("doc_id")), "cid")
    ids = _few(stored(one.select("doc_id").distinct(), "jaccard-chosen"), broadcast_rows)
    chosen = docs.select("doc_id", "text").join(ids.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    kind = docs.schema["doc_id"].dataType.simpleString()
    sketches = ", ".join(f"{name} bigint" for name in SKETCH)
    made = _sets(chosen, f"doc_id {kind}, cid bigint, codes array<bigint>, {sketches}", percent, True).drop("doc_id")
    return stored(made.join(wanted.select("cid"), "cid", "left_semi").dropDuplicates(["cid"]), "jaccard-codes")


def _rooted(docs: DataFrame, percent: int, digests: bool) -> tuple[DataFrame, DataFrame]:
    """Every document's class, and of every class its smallest doc_id, its copies and the root of its component."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    more = "digest binary, " if digests else ""
    sets = stored(_sets(docs, f"doc_id {kind}, {more}cid bigint, n int, codes array<bigint>", percent, False), "jaccard-sets")
    classes = sets.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("low"), F.count("*").alias("copies"))
    found = links(docs, sets, percent)
    labels = connected(found)
    return sets, classes.join(labels, "cid", "left").select("cid", "low", "copies", F.coalesce("label", "cid").alias("root"))


def components(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every document; links need 100 * shared >= percent * united shingles."""
    sets, rooted = _rooted(docs.select("doc_id", "text"), percent, False)
    roots = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("n"))
    named = salted_join(rooted, roots, "root", "n", F.xxhash64("cid")).select("cid", "component_id", "copies")
    members = sets.where("n > 0").select("doc_id", "cid", "n")
    joined = salted_join(members, named, "cid", "copies", F.xxhash64("doc_id"))
    columns = ["doc_id", F.col("n").cast("long").alias("n_shingles")]
    alone = sets.where("n = 0").select(*columns, F.col("doc_id").alias("component_id"))
    return joined.select(*columns, "component_id").union(alone)


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest doc_id, or any if none has one.

    Rows are told apart by doc_id and text, so an id that several texts share keeps no copies, and rows without an
    id are judged like others. Texts without words are linked with nothing: all of them stay, but of rows with the same id one.
    """
    sets, rooted = _rooted(docs.select("doc_id", "text"), percent, True)
    members = sets.where("n > 0").select("doc_id", "digest", "cid")
    named = salted_join(members, rooted.select("cid", "copies", "root"), "cid", "copies", F.xxhash64("doc_id", "digest"))
    first = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")).alias("first"))
    # How many rows have an id and text, and whether one of them stays. Rows without words or id are not looked at: all stay.
    counted = sets.where("n > 0 OR doc_id IS NOT NULL").select("doc_id", "digest", F.lit(1).alias("m"), (F.col("n") == 0).alias("stays"))
    chosen = first.select("first.doc_id", "first.digest", F.lit(0).alias("m"), F.lit(True).alias("stays"))
    keys = counted.union(chosen).groupBy("doc_id", "digest").agg(F.sum("m").alias("m"), F.max("stays").alias("__stays"))
    keys = keys.where("m > 1 OR NOT __stays").select(F.col("doc_id").alias("__kept_id"), F.col("digest").alias("__kept_digest"), "__stays")
    return _without_copies(docs, stored(keys, "jaccard-copies"))


def _without_copies(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id and text are among ``copies``, but one row where that says ``__stays``.

    Only rows that a sieve of ``copies`` lets through are joined exactly, so few texts move where few rows are copies.
    """
    found = F.xxhash64(docs["doc_id"], text_digest()), copies, F.xxhash64("__kept_id", "__kept_digest")
    same = docs["doc_id"].eqNullSafe(copies["__kept_id"]) & (text_digest() == copies["__kept_digest"])
    looked_at = sieved(docs, *found)
    others = looked_at.join(copies, same, "left_anti")
    once = looked_at.join(copies.where("__stays"), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return sieved(docs, *found, "left_anti").union(others).union(once)

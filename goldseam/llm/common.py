"""What the operators share: needed columns, training samples, and joins that a hot key cannot slow down."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.session import scratch_path

SPAN = 2**63


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; whatever else it holds cannot clash with ours."""
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def held_out(doc_id: str | Column) -> Column:
    """True for rows that no model may learn from; a row without an id is not held out, but not learnt from either."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def learnable(doc_id: str | Column) -> Column:
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string")) % 3 != 1, F.lit(False))


def hash_share(key: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the key only, so a repeated task draws the same sample."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 1) / F.lit(float(SPAN))


def class_sample(df: DataFrame, key: str, label: str, per_class: int, seed: int = 7) -> DataFrame:
    """About ``per_class`` rows of each class (all of a smaller one), chosen by a hash of the key.

    ``df`` should hold key and label only; the classes must be few (labels, languages).
    """
    rows = df.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    share = F.lit(0.0)
    for value, size in sorted(sizes.items(), key=str):
        share = F.when(F.col(label) == F.lit(value), F.lit(per_class / size)).otherwise(share)
    return rows.where(hash_share(key, seed) < share)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_bytes: int, seed: int = 7
) -> DataFrame:
    """(doc_id, label, text as binary) of about ``per_class`` learnable labelled rows of each class.

    Two bounds, both parameters of the operators: rows per class and bytes of a text. The ids
    are broadcast, as there are at most a few thousand; the text is read in one scan and never
    shuffled. Only fitting uses this sample; scoring reads every whole text.
    """
    chosen = class_sample(
        labels.where(learnable("doc_id")).select("doc_id", F.col(label).cast("int").alias("label")), "doc_id", "label", per_class, seed
    ).dropDuplicates(["doc_id"])
    texts = docs.where(F.octet_length("text") <= max_bytes).select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")


def by_id(frame, *columns: str):
    """A collected sample in an order that does not depend on tasks, so that every fit is repeatable."""
    return frame.sort_by([(c, "ascending") for c in columns])


HOT_KEYS = 10_000
SALT_ROWS = 256


def salted_join(
    rows: DataFrame, sides: DataFrame, key: str, count: str, spread: Column, how: str = "inner", salt_rows: int = SALT_ROWS
) -> DataFrame:
    """Join ``rows`` with ``sides``, which has few rows per key and in ``count`` how many of ``rows`` carry it.

    The keys with most rows, at most HOT_KEYS of them and each above ``salt_rows``, are looked up first and
    broadcast; without any, this is a plain join. Their rows go to one of count / salt_rows salts by ``spread``, and their side
    is repeated once per salt, which adds at most one row to ``sides`` for ``salt_rows`` rows. Any
    other key holds less than one part in HOT_KEYS of all rows. The result is that of a plain
    join; null keys match nothing.
    """
    hot = (
        sides.where(F.col(count) > salt_rows)
        .select(key, count)
        .distinct()
        .orderBy(F.col(count).desc(), F.col(key))
        .limit(HOT_KEYS)
        .select(key, F.ceil(F.col(count) / salt_rows).cast("int").alias("_salts"))
        .collect()
    )
    if not hot:
        return rows.join(sides, key, how)
    kind = sides.schema[key].dataType.simpleString()
    few = F.broadcast(sides.sparkSession.createDataFrame(hot, f"`{key}` {kind}, _salts int"))
    left = rows.join(few, key, "left").withColumn(
        "_salt", F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(F.pmod(spread, F.col("_salts")).cast("int"))
    )
    right = sides.join(few, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    )
    return left.drop("_salts").join(right.drop("_salts"), [key, "_salt"], how).drop("_salt")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the folder that all executors share and read back, which also cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(rows: DataFrame, sides: DataFrame, on: str, count: str, spread: Column, bound: int = 20_000) -> DataFrame:
    """Left join with ``sides``, one row per key: broadcast if it has at most ``bound`` rows, else a salted join."""
    if sides.limit(bound + 1).count() <= bound:
        return rows.join(F.broadcast(sides.drop(count)), on, "left")
    return salted_join(rows, sides, on, count, spread, "left").drop(count)


#: Words of 64 bits in a sieve at most; they are broadcast, with their places.
SIEVE_WORDS = 1 << 19


def sieved(rows: DataFrame, hashed: Column, keys: DataFrame, key: Column, how: str = "left_semi", words: int | None = None) -> DataFrame:
    """The ``rows`` whose ``hashed`` may be a ``key`` of ``keys`` (``left_anti``: those for which it surely is none).

    A broadcast bitmap of bounded size decides, so no row moves for it. Both columns are 64-bit hashes that are
    never null. All rows with a key pass; of the others about one part in 64 * words / keys, which an exact join has to tell
    apart afterwards. Beyond that many keys all rows pass.
    """
    words = words or SIEVE_WORDS

    def bit(value: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), value.bitwiseAND(F.lit(63)).cast("int"))

    def word(value: Column) -> Column:
        return F.pmod(F.shiftright(value, 6), F.lit(words)).cast("bigint")

    bits = keys.groupBy(word(key).alias("__word")).agg(F.bit_or(bit(key)).alias("__bits"))
    hit = (word(hashed) == bits["__word"]) & (bits["__bits"].bitwiseAND(bit(hashed)) != 0)
    return rows.join(F.broadcast(bits), hit, how)


def trimmed(mapped):
    """``mapped`` for mapInArrow; at the end of a task its worker gives back the memory that Arrow keeps of freed batches,
    which an idle worker would hold through later stages."""

    def run(batches):
        yield from mapped(batches)
        pa.default_memory_pool().release_unused()

    return run


def by_bytes(batches, column: str, most: int):
    """Record batches cut so that the texts of each hold at most ``most`` bytes, or are one row."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            done = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, done + most, "right")))
            yield batch.slice(begin, end - begin)
            begin = end

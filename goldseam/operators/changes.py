"""Update, delete, upsert, and the state and history of a change log, as frames.

Plain Spark tables have no UPDATE, DELETE or MERGE. These operators return the table's
next state, to be written as a new table or as the partitions it replaces.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldseam.operators.shaping import other_columns


def update_where(df: DataFrame, condition: Column, sets: Mapping[str, Column]) -> DataFrame:
    """Rows meeting the condition get the new values; a NULL condition leaves a row alone."""
    types = dict(df.dtypes)
    changed = {
        name: F.when(condition, value.cast(types[name])).otherwise(F.col(name)) for name, value in sets.items()
    }
    return df.withColumns(changed)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that do not meet the condition; a NULL condition keeps a row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after a merge: matched rows take the source's values, the others are added.

    The source is cast to the target's types first. NULL keys never match, so such source
    rows are always added. Several source rows of one key raise an error when the plan runs.

    A target key may be hot. The update is a left join of two plain shuffles, which adaptive
    execution can split; the insert compares with distinct target keys, one row per key and
    map task. A full outer join could not be split.
    """
    source = source.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields))
    payload = other_columns(target, keys)
    has_key = F.lit(True)
    for key in keys:
        has_key = has_key & F.col(key).isNotNull()
    keyed = source.filter(has_key)

    copies = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)))
    refuse = F.raise_error(F.lit("several source rows for one key")).cast("boolean")
    unique = F.when(copies.scalar() > 1, refuse).otherwise(F.lit(True))
    news = keyed.select(*keys, F.struct(*payload).alias("_new")).filter(unique)

    updated = target.join(news, list(keys), "left").select(
        *(
            F.col(c)
            if c in set(keys)
            else F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c)
            for c in target.columns
        )
    )
    known = target.select(*keys).distinct()
    added = news.join(known, list(keys), "left_anti").select(*keys, "_new.*").select(*target.columns)
    return updated.unionByName(added).unionByName(source.filter(~has_key))


def as_of(
    log: DataFrame,
    keys: Sequence[str],
    version: int | None = None,
    ts: datetime | str | None = None,
    order: Sequence[str] = ("version",),
    delete_op: str = "delete",
) -> DataFrame:
    """The table as its change log left it at a version or a time (bounds included).

    ``log`` has columns ``op``, ``version``, ``ts`` besides keys and payload. ``order``
    must rank the changes of one key without ties.
    """
    if version is not None:
        log = log.filter(F.col("version") <= version)
    if ts is not None:
        log = log.filter(F.col("ts") <= F.lit(ts).cast(dict(log.dtypes)["ts"]))
    payload = [c for c in other_columns(log, keys) if c not in ("op", "version", "ts", *order)]
    change = F.struct("op", *payload)
    last = log.groupBy(*keys).agg(F.max_by(change, F.struct(*order)).alias("last"))
    return last.filter(F.col("last")["op"] != delete_op).select(*keys, *(F.col("last")[c].alias(c) for c in payload))


def last_changes(log: DataFrame, keys: Sequence[str], order: Sequence[str] = ("version",)) -> DataFrame:
    """The last change of every key, in the columns of the log."""
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*log.columns), F.struct(*order)).alias("last"))
    return last.select(*(F.col("last")[c].alias(c) for c in log.columns))


def write_snapshots(log: DataFrame, keys: Sequence[str], path: str, span: int, delete_op: str = "delete") -> int:
    """Stores a change log by epochs of ``span`` versions, and the state at the start of each; returns the number of epochs.

    Each state is made from the one before and the changes between, so no change is read more than twice.
    """
    spark, epoch = log.sparkSession, F.floor(F.col("version") / span).cast("int")
    log.withColumn("epoch", epoch).hint("rebalance", "epoch").write.partitionBy("epoch").parquet(f"{path}/log")
    stored = spark.read.schema(f"{_ddl(log)}, epoch int").parquet(f"{path}/log")
    latest = stored.agg(F.max("epoch")).first()[0]
    state = log.limit(0)
    for start in range(1, (latest or 0) + 1):
        news = stored.where(F.col("epoch") == start - 1).drop("epoch")
        last_changes(state.unionByName(news), keys).where(F.col("op") != delete_op).write.parquet(f"{path}/state/{start}")
        state = spark.read.schema(log.schema).parquet(f"{path}/state/{start}")
    return (latest or 0) + 1


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def as_of_snapshot(log_schema: DataFrame, keys: Sequence[str], path: str, span: int, epochs: int, version: int, delete_op: str = "delete") -> DataFrame:
    """``as_of`` a version from stored snapshots: the state at the start of its epoch and the changes since.

    ``log_schema`` is any frame with the log's columns. Files of other epochs are not read.
    """
    spark, epoch = log_schema.sparkSession, min(max(version // span, 0), epochs - 1)
    stored = spark.read.schema(f"{_ddl(log_schema)}, epoch int").parquet(f"{path}/log")
    changes = stored.where(F.col("epoch") == epoch).drop("epoch")
    if epoch > 0:
        changes = changes.unionByName(spark.read.schema(log_schema.schema).parquet(f"{path}/state/{epoch}"))
    return as_of(changes, keys, version=version, delete_op=delete_op)


def change_history(log: DataFrame, by: Sequence[str] = ("version", "op")) -> DataFrame:
    """Changes per version and kind, with the time they span."""
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_changes"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )

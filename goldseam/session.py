"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot join partition even where the next operator then needs one more shuffle:
    # a key with a third of all rows costs far more in one task than that shuffle does.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def partitions_for(shuffle_bytes: int, partition_bytes: int = 128 << 20, least: int = 200) -> int:
    """Shuffle partitions that keep each near ``partition_bytes``, so that it fits a task's memory."""
    return max(least, -(-shuffle_bytes // partition_bytes))


def build_session(
    app_name: str = "goldseam", master: str | None = None, shuffle_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings this library is tuned for; ``conf`` adds to or overrides them.

    Give the bytes of the largest shuffle to expect (the columns in use of the largest
    fact). Adaptive execution can merge partitions that turn out small, but not make more.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sizing = {} if shuffle_bytes is None else {"spark.sql.shuffle.partitions": str(partitions_for(shuffle_bytes))}
    for key, value in {**SESSION_CONF, **sizing, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    existing = context.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="goldseam-")
    context.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, so that a lost executor cannot change it."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"

"""Registration of the queries of this subpackage."""

from __future__ import annotations

import functools
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies; on a cluster it is shipped with ``--py-files``."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder), with SQL where that can say the same."""

    def register(build):
        @functools.wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            importable(spark)
            return build(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register

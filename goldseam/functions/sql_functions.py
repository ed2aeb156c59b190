"""Scalar SQL functions kept in the session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_threshold(spark: SparkSession, name: str, threshold: float) -> str:
    """A SQL function ``name(x DOUBLE) -> BOOLEAN`` that is true above ``threshold``.

    Spark inlines its body into the plan, so it is pushed down like a written comparison.
    """
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x DOUBLE) RETURNS BOOLEAN RETURN x > CAST({threshold!r} AS DOUBLE)"
    )
    return name

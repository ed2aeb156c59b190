"""Run a bound query on Spark and its SQL on DuckDB and compare names, types and values."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(folder) / name}.parquet'")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t) or pa.types.is_string_view(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    return str(t)


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return str(value)  # tells 0.0 from -0.0
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    return value


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [[_cell(v) for v in table.column(n).to_pylist()] for n in names]
    return sorted(zip(*columns), key=lambda row: tuple((v is None, type(v).__name__, v if v is not None else 0) for v in row))


def differences(spark: SparkSession, con, name: str, build, sql: str, folder: str) -> list[str]:
    """What differs, as text; empty when both agree."""
    ours: pa.Table = build(spark, folder).toArrow()
    theirs: pa.Table = con.sql(sql).to_arrow_table()
    found = []
    our_types = {f.name: _kind(f.type) for f in ours.schema}
    their_types = {f.name: _kind(f.type) for f in theirs.schema}
    if our_types != their_types:
        found.append(f"schema: ours {sorted(our_types.items() - their_types.items())}, "
                     f"sql {sorted(their_types.items() - our_types.items())}")
    if ours.num_rows != theirs.num_rows:
        found.append(f"rows: ours {ours.num_rows}, sql {theirs.num_rows}")
    if set(our_types) == set(their_types):
        a, b = _rows(ours), _rows(theirs)
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        if bad:
            found.append(f"{len(bad)} rows differ, first: ours {bad[0][0]}, sql {bad[0][1]}")
    if ours.num_rows == 0:
        found.append("no rows at all")
    return found

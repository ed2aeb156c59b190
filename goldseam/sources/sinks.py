"""Table sinks, appends, views, and the checks that follow a write."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructField

from goldseam.operators.joins import hot_keys


def write_layer(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    verify: bool = False,
    bucket_by: tuple[str, int] | None = None,
    path: str | None = None,
) -> int:
    """Replace table ``name`` (rows and schema) with ``df``; returns the rows written.

    The count is observed during the write, so the input is computed once.
    """
    return write_checked(df, name, {}, fmt, partition_by, verify, bucket_by, path)["rows"]


def can_bucket(sides: Iterable[tuple[DataFrame, str]], buckets: int, min_rows: int = 1_000_000) -> bool:
    """Whether (frame, key) pairs can be stored in buckets by their keys to be joined without a shuffle.

    A bucket is read by one task, which adaptive execution cannot split. So a key that holds more rows than a bucket's share
    of its frame, and at least ``min_rows``, is for the plain layout, whose joins are split where they are skewed.
    """
    return not any(hot_keys(df, key, 1 / buckets, min_rows) for df, key in sides)


def row_checksum(df: DataFrame) -> Column:
    """Aggregate: a sum of hashes of all rows, the same for any order of them; maps count by their sorted entries."""

    def hashable(field: StructField) -> Column:
        column = F.col("`" + field.name.replace("`", "``") + "`")
        return F.array_sort(F.map_entries(column)) if isinstance(field.dataType, MapType) else column

    # A constant keeps a row of NULLs from counting for nothing.
    hashed = F.xxhash64(F.lit(1), *(hashable(f) for f in df.schema.fields))
    return F.coalesce(F.sum(hashed.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))


def write_checked(
    df: DataFrame,
    name: str,
    rules: Mapping[str, Column],
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    verify: bool = False,
    bucket_by: tuple[str, int] | None = None,
    path: str | None = None,
) -> dict[str, int]:
    """``write_layer`` that also counts the failures of quality rules in the same pass.

    A rule is the condition of a failing row. Returns {"rows": n, rule: failures, ...}.
    Rows of one partition value are brought together first, so that each task does not
    leave a small file in every partition; a hot value is split over several files.
    With ``verify`` the table is read back, and its rows must be as many and the same as those that were written.
    ``bucket_by`` a key and a number stores that many buckets, each sorted and one file per partition value: tables
    with as many buckets by the same type of key join without a shuffle. See ``can_bucket``. The table lies at ``path`` if given.
    """
    plain = df
    if bucket_by:
        key, number = bucket_by
        df = df.repartition(number, key)  # dealt like the buckets, so each task writes one
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    seen = Observation()
    counts = {"rows": F.count(F.lit(1)), **{rule: F.count(F.when(fails, 1)) for rule, fails in rules.items()}}
    if verify:
        counts["_checksum"] = row_checksum(plain)
    observed = df.observe(seen, *(count.alias(label) for label, count in counts.items()))
    writer = observed.write.format(fmt).mode("overwrite")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(number, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    found = dict(seen.get)
    if verify:
        verify_write(df.sparkSession, name, found["rows"], found.pop("_checksum"), plain.columns)
    return found


def write_verified(df: DataFrame, path: str) -> DataFrame:
    """Writes Parquet files and reads them back; one row: rows written, rows read, and whether they are the same."""
    seen = Observation()
    checks = {"n_rows": F.count(F.lit(1)), "checksum": row_checksum(df)}
    df.observe(seen, *(check.alias(n) for n, check in checks.items())).write.parquet(path)
    written, back = seen.get, df.sparkSession.read.schema(df.schema).parquet(path)
    return back.agg(
        F.lit(written["n_rows"]).cast("bigint").alias("rows_written"),
        F.count(F.lit(1)).alias("rows_read"),
        ((F.count(F.lit(1)) == written["n_rows"]) & (row_checksum(back) == F.lit(written["checksum"]))).alias("same"),
    )


def rewrite_table(spark: SparkSession, name: str, change: Callable[[DataFrame], DataFrame]) -> int:
    """Replace a table by a change of itself (update, delete, upsert); returns its rows.

    The next state is written in full beside the table first, so a job that fails until then leaves the
    table as it was. A plain table then steps aside, the next state takes its name, and only then the old one is dropped.
    A partitioned one is overwritten from the stored next state, in its own format and partitions.

    A job that dies in this last step leaves whole states under other names. If the change was decided by then, the next call
    finishes it and ends there, without changing anything once more; otherwise it starts from the old state.
    """
    staged, ready, aside = f"{name}__next", f"{name}__ready", f"{name}__old"
    exists = spark.catalog.tableExists

    def overwrite() -> int:
        # Renaming would leave a partitioned table's partitions where they were.
        spark.table(ready).select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
        spark.sql(f"DROP TABLE {ready}")
        return spark.table(name).count()

    if exists(ready):
        return overwrite()
    if exists(aside):
        if exists(name):
            spark.sql(f"DROP TABLE {aside}")
            return spark.table(name).count()
        spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
    described = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    partitioned = any(column.isPartition for column in spark.catalog.listColumns(name))
    rows = write_layer(change(spark.table(name)), staged, described["Provider"].lower())
    if partitioned:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {ready}")
        overwrite()
    else:
        spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
        spark.sql(f"DROP TABLE {aside}")
    return rows


def verify_write(spark: SparkSession, name: str, expected: int, checksum: Decimal | None = None, columns: Sequence[str] = ()) -> None:
    """Read the table back and raise unless it holds ``expected`` rows, and with a ``checksum`` those rows."""
    table = spark.table(name)
    if checksum is None:
        found = table.count()
    else:
        table = table.select(*(F.col("`" + c.replace("`", "``") + "`") for c in columns or table.columns))
        found, read = table.agg(F.count(F.lit(1)), row_checksum(table)).first()
    if found != expected:
        raise ValueError(f"{name}: expected {expected} rows, found {found}")
    if checksum is not None and read != checksum:
        raise ValueError(f"{name}: the rows read back are not those written")


def create_table(spark: SparkSession, name: str, columns: str, fmt: str = "parquet") -> None:
    """An empty table with the columns of a DDL text, replacing one of that name."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt}")


def insert_rows(spark: SparkSession, name: str, rows: Iterable[Sequence]) -> None:
    """Append rows given in the program to an existing table, in its column order."""
    spark.createDataFrame(list(rows), spark.table(name).schema).write.insertInto(name)


def append_rows(df: DataFrame, rows: Iterable[Sequence]) -> DataFrame:
    """``df`` followed by rows given in the program."""
    return df.unionByName(df.sparkSession.createDataFrame(list(rows), df.schema))


def create_view(spark: SparkSession, name: str, source: DataFrame | str) -> DataFrame:
    """A view over SQL text (kept in the catalog) or over a frame (kept for the session)."""
    if isinstance(source, str):
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {source}")
    else:
        source.createOrReplaceTempView(name)
    return spark.table(name)


def replace_with_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """A catalog view in the place of whatever had its name."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    return create_view(spark, name, query)


def projected_view(df: DataFrame, name: str, columns: Sequence[str], condition: Column) -> DataFrame:
    """A session view showing ``columns`` of the rows that meet ``condition``."""
    return create_view(df.sparkSession, name, df.filter(condition).select(*columns))


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per frame: (table_name, rows)."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def missing_tables(spark: SparkSession, database: str, expected: Sequence[str]) -> list[str]:
    """The expected tables that the database does not list."""
    present = {table.name for table in spark.catalog.listTables(database)}
    return [name for name in expected if name not in present]

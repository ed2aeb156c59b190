"""Scans: CSV, Parquet, binary files, catalog tables and rows written in the program."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """CSV files as a frame. Without ``schema`` Spark reads the files twice to guess one.

    With a header and a schema, columns are found by name: the files may hold them in any order,
    and others beside them. All files of one call must have the same header; one that
    differs stops the job. Text that does not fit its type becomes NULL. Without a header, columns go by place.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if not header:
        return reader.schema(schema).csv(path)
    text = reader.option("enforceSchema", False).csv(path)
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    missing = [f.name for f in fields if f.name not in text.columns]
    if missing:
        raise ValueError(f"no such columns in the header: {', '.join(missing)}")
    return text.select(*(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in fields))


CORRUPT = "_corrupt_record"


def read_csv_kept(spark: SparkSession, path: str | list[str], columns: Sequence[str] = (), sep: str = ",", header: bool = True) -> DataFrame:
    """CSV files as text columns, and in ``_corrupt_record`` the whole text of records that have too few or too many values.

    Nothing is guessed, dropped or cast: what becomes of such records is for ``rejects.judge`` to say. ``columns`` names them where there is no header.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    names = list(columns) if not header else reader.csv(path).columns
    schema = StructType([StructField(name, StringType()) for name in [*names, CORRUPT]])
    # With pruned columns the reader would not see a value too many.
    reader = reader.option("enforceSchema", False).option("columnPruning", False)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def read_parquet(spark: SparkSession, *paths: str, schema: StructType | str | None = None) -> DataFrame:
    """Parquet files as a frame. With ``schema`` no job is spent on reading file footers for one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def read_binary(spark: SparkSession, path: str, name_glob: str | None = None) -> DataFrame:
    """One row per file below ``path``: path, modificationTime, length, content.

    The bytes are read only by plans that use ``content``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


SMALL = 10_000  # rows


def inline_rows(spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str) -> DataFrame:
    """A frame of rows given in the program, marked for broadcast while it is small.

    Spark does not know the size of such a frame, and would shuffle a large fact to join it.
    """
    rows = list(rows)
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= SMALL else df


def empty_frame(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """No rows, but the columns and types that later steps rely on."""
    return spark.createDataFrame([], schema)

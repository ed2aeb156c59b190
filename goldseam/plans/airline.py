"""Airline operations: flights, airports, aircraft and maintenance, from CSV to two KPI tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.operators import measures as ms
from goldseam.operators.aggregates import kpi
from goldseam.operators.quality import key_report
from goldseam.operators.shaping import conform, dedupe, not_null, valid_range
from goldseam.sources.readers import read_csv
from goldseam.sources.sinks import write_layer

# File names, column names, types and flight states of the source files.
FILES = {
    "vuelos": "vuelos_diarios.csv",
    "aeronaves": "aeronaves.csv",
    "aeropuertos": "aeropuertos.csv",
    "mantenimientos": "mantenimientos_rds.csv",
}
COLUMNS = {
    "vuelos": {
        "vuelo_id": "string",
        "fecha": "date",
        "origen_id": "string",
        "destino_id": "string",
        "aeronave_id": "string",
        "estado": "string",
        "duracion_min": "int",
    },
    "aeronaves": {
        "aeronave_id": "string",
        "modelo": "string",
        "fabricante": "string",
        "anio_fabricacion": "int",
    },
    "aeropuertos": {
        "aeropuerto_id": "string",
        "nombre": "string",
        "ciudad": "string",
        "pais": "string",
        "lat": "double",
        "lon": "double",
    },
    "mantenimientos": {
        "mantenimiento_id": "string",
        "aeronave_id": "string",
        "fecha": "date",
        "tipo": "string",
        "costo_usd": "double",
        "duracion_hr": "double",
    },
}
ON_TIME, DELAYED, CANCELLED = "a_tiempo", "retrasado", "cancelado"
STAMP = "ingestion_time"

Tables = Mapping[str, DataFrame]


def landing(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The CSV files with every column as text: typing is bronze's work, and nothing is guessed."""
    return {
        name: read_csv(spark, f"{folder}/{file}", ", ".join(f"{column} STRING" for column in COLUMNS[name]))
        for name, file in FILES.items()
    }


def bronze(raw: Tables) -> dict[str, DataFrame]:
    return {name: conform(df, COLUMNS[name], STAMP) for name, df in raw.items()}


def silver_flights(df: DataFrame) -> DataFrame:
    return dedupe(conform(df.select(*COLUMNS["vuelos"]), COLUMNS["vuelos"]), ["vuelo_id"])


def silver_airports(df: DataFrame) -> DataFrame:
    typed = conform(df.select(*COLUMNS["aeropuertos"]), COLUMNS["aeropuertos"])
    placed = valid_range(typed, {"lat": (-90, 90), "lon": (-180, 180)})
    return dedupe(placed, ["aeropuerto_id"])


def silver_aircraft(df: DataFrame) -> DataFrame:
    typed = conform(df.select(*COLUMNS["aeronaves"]), COLUMNS["aeronaves"])
    return dedupe(not_null(typed, ["anio_fabricacion"]), ["aeronave_id"])


def silver_maintenance(df: DataFrame) -> DataFrame:
    typed = conform(df.select(*COLUMNS["mantenimientos"]), COLUMNS["mantenimientos"])
    return dedupe(typed, ["mantenimiento_id"])


def silver(bronze_tables: Tables) -> dict[str, DataFrame]:
    return {
        "vuelos": silver_flights(bronze_tables["vuelos"]),
        "aeropuertos": silver_airports(bronze_tables["aeropuertos"]),
        "aeronaves": silver_aircraft(bronze_tables["aeronaves"]),
        "mantenimientos": silver_maintenance(bronze_tables["mantenimientos"]),
    }


def flight_quality(flights: DataFrame) -> DataFrame:
    return key_report(flights, ["vuelo_id"])


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumns({"anio": F.year("fecha"), "mes": F.month("fecha")})


def punctuality(flights: DataFrame, airports: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Flights by state, mean duration and punctuality per aircraft model, origin country and month."""
    return kpi(
        _with_month(flights),
        ["modelo", "fabricante", "origen_pais", "mes", "anio"],
        {
            "total_vuelos": ms.count_present("vuelo_id"),
            "vuelos_a_tiempo": ms.count_where(F.col("estado") == ON_TIME),
            "vuelos_retrasados": ms.count_where(F.col("estado") == DELAYED),
            "vuelos_cancelados": ms.count_where(F.col("estado") == CANCELLED),
            "duracion_promedio_min": ms.mean("duracion_min"),
        },
        {"puntualidad_pct": ("vuelos_a_tiempo", "total_vuelos")},
        [
            ms.Dimension(airports, {"origen_id": "aeropuerto_id"}, {"origen_pais": "pais"}),
            ms.Dimension(aircraft, {"aeronave_id": "aeronave_id"}, ["modelo", "fabricante"]),
        ],
    )


def maintenance_cost(maintenance: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Jobs, cost and hours per aircraft, kind of job and month."""
    return kpi(
        _with_month(maintenance),
        ["aeronave_id", "modelo", "fabricante", "tipo", "mes", "anio"],
        {
            "total_mantenimientos": ms.count_present("mantenimiento_id"),
            "costo_promedio_usd": ms.mean("costo_usd"),
            "costo_total_usd": ms.total("costo_usd"),
            "duracion_promedio_hr": ms.mean("duracion_hr"),
            "duracion_total_hr": ms.total("duracion_hr"),
        },
        dimensions=[ms.Dimension(aircraft, {"aeronave_id": "aeronave_id"}, ["modelo", "fabricante"])],
    )


def gold(silver_tables: Tables) -> dict[str, DataFrame]:
    return {
        "kpi_puntualidad_vuelos": punctuality(
            silver_tables["vuelos"], silver_tables["aeropuertos"], silver_tables["aeronaves"]
        ),
        "kpi_costo_mantenimiento": maintenance_cost(silver_tables["mantenimientos"], silver_tables["aeronaves"]),
    }


def run(spark: SparkSession, folder: str, database: str, fmt: str = "parquet", verify: bool = True) -> dict[str, int]:
    """All layers, each read back from its tables: {table: rows written}. ``verify`` compares what was written with what is read."""
    written = {}
    tables: Tables = landing(spark, folder)
    for layer, build in (("bronze", bronze), ("silver", silver), ("gold", gold)):
        stored = {}
        for name, df in build(tables).items():
            table = f"{database}.{layer}_{name}"
            written[table] = write_layer(df, table, fmt, verify=verify)
            stored[name] = spark.table(table)
        tables = stored
    return written

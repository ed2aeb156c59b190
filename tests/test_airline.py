from datetime import date

import pytest

from goldseam.plans import airline


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "vuelos_diarios.csv").write_text(
        "vuelo_id,fecha,origen_id,destino_id,aeronave_id,estado,duracion_min\n"
        "1,2024-01-05,10,11,100,a_tiempo,60\n"
        "1,2024-01-05,10,11,100,a_tiempo,60\n"
        "2,2024-01-07,10,11,100,retrasado,61\n"
        "3,2024-01-09,10,11,100,cancelado,\n"
        "4,2024-02-01,99,11,777,a_tiempo,soon\n"
    )
    (tmp_path / "aeronaves.csv").write_text(
        "aeronave_id,modelo,fabricante,anio_fabricacion\n100,A320,Airbus,2010\n200,B737,Boeing,unknown\n"
    )
    (tmp_path / "aeropuertos.csv").write_text(
        "aeropuerto_id,nombre,ciudad,pais,lat,lon\n10,Barajas,Madrid,Spain,40.4,-3.7\n12,Nowhere,X,Y,95,0\n13,Gap,X,Y,,0\n"
    )
    (tmp_path / "mantenimientos_rds.csv").write_text(
        "mantenimiento_id,aeronave_id,fecha,tipo,costo_usd,duracion_hr\n"
        "m1,100,2024-01-02,engine,100.10,2.5\nm2,100,2024-01-30,engine,100.13,3\nm3,200,2024-01-30,cabin,10,1\n"
    )
    return str(tmp_path)


def test_all_layers(spark, landing, values):
    spark.sql("CREATE DATABASE IF NOT EXISTS airline")
    written = airline.run(spark, landing, "airline")
    assert written == {
        "airline.bronze_vuelos": 5, "airline.bronze_aeronaves": 2, "airline.bronze_aeropuertos": 3,
        "airline.bronze_mantenimientos": 3, "airline.silver_vuelos": 4, "airline.silver_aeropuertos": 1,
        "airline.silver_aeronaves": 1, "airline.silver_mantenimientos": 3,
        "airline.gold_kpi_puntualidad_vuelos": 2, "airline.gold_kpi_costo_mantenimiento": 2,
    }
    assert airline.flight_quality(spark.table("airline.silver_vuelos")).first() == (4, 0, 0, 0)
    assert spark.table("airline.bronze_vuelos").schema["fecha"].dataType.simpleString() == "date"
    assert values(spark.table("airline.gold_kpi_puntualidad_vuelos")) == [
        (None, None, None, 2, 2024, 1, 1, 0, 0, None, 100.0),
        ("A320", "Airbus", "Spain", 1, 2024, 3, 1, 1, 1, 60.5, 33.33),
    ]
    assert values(spark.table("airline.gold_kpi_costo_mantenimiento")) == [
        ("100", "A320", "Airbus", "engine", 1, 2024, 2, 100.12, 200.23, 2.75, 5.5),
        ("200", None, None, "cabin", 1, 2024, 1, 10.0, 10.0, 1.0, 1.0),
    ]


def test_silver_types(spark, landing):
    silver = airline.silver(airline.bronze(airline.landing(spark, landing)))
    flight = silver["vuelos"].filter("vuelo_id = '4'").first()
    assert flight["duracion_min"] is None and flight["fecha"] == date(2024, 2, 1)

import pytest
from pyspark.sql import functions as F

from goldseam import session
from goldseam.operators import changes
from goldseam.sources import readers, sinks


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("id;fecha;precio\n1;2025-05-01;10.5\n2;2025-06-01;\n")
    return str(path)


def test_csv_inferred_and_declared(spark, csv_file):
    inferred = readers.read_csv(spark, csv_file, sep=";")
    assert inferred.dtypes == [("id", "int"), ("fecha", "date"), ("precio", "double")]
    declared = readers.read_csv(spark, csv_file, "id STRING, fecha STRING, precio DOUBLE", sep=";")
    assert [tuple(r) for r in declared.collect()] == [("1", "2025-05-01", 10.5), ("2", "2025-06-01", None)]


def test_binary_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "dent_1.png").write_bytes(b"\x01\x02")
    (tmp_path / "note.txt").write_text("x")
    df = readers.read_binary(spark, str(tmp_path), "*.png")
    assert df.columns == ["path", "modificationTime", "length", "content"]
    assert [(r["length"], bytes(r["content"])) for r in df.collect()] == [(2, b"\x01\x02")]


def test_inline_and_empty(spark):
    assert readers.inline_rows(spark, [(1, "a")], "k INT, t STRING").collect() == [(1, "a")]
    empty = readers.empty_frame(spark, "k INT, m MAP<STRING, DOUBLE>")
    assert empty.count() == 0 and empty.dtypes == [("k", "int"), ("m", "map<string,double>")]


def test_write_replaces_rows_and_schema_and_counts(spark, frame):
    assert sinks.write_layer(frame([(1,), (2,)], "k INT"), "layers.t") == 2
    assert sinks.write_layer(frame([("x", 2020)], "s STRING, anio INT"), "layers.t", partition_by=["anio"]) == 1
    assert readers.read_table(spark, "layers.t").collect() == [("x", 2020)]
    sinks.verify_write(spark, "layers.t", 1)
    with pytest.raises(ValueError, match="expected 5 rows, found 1"):
        sinks.verify_write(spark, "layers.t", 5)
    assert sinks.write_layer(frame([], "k INT"), "layers.empty") == 0


def test_write_counts_rule_failures_in_the_same_pass(frame):
    df = frame([(1, "a"), (None, "b"), (3, None)], "k INT, t STRING")
    rules = {"no_key": F.col("k").isNull(), "big": F.col("k") > 2}
    assert sinks.write_checked(df, "layers.checked", rules) == {"rows": 3, "no_key": 1, "big": 1}


def test_shuffle_sizing():
    assert session.partitions_for(0) == 200
    assert session.partitions_for(10 * 2**40) == 81_920


def test_create_insert_and_view(spark, values):
    sinks.create_table(spark, "layers.simple", "id INT, letra STRING, valor DOUBLE")
    sinks.insert_rows(spark, "layers.simple", [(1, "A", 10.5), (2, "B", 20.0)])
    sinks.insert_rows(spark, "layers.simple", [(3, "C", 30.75)])
    view = sinks.create_view(spark, "layers.vw_simple", "SELECT id, letra FROM layers.simple WHERE valor > 15")
    assert values(view) == [(2, "B"), (3, "C")]
    shown = sinks.projected_view(spark.table("layers.simple"), "vw_session", ["id"], F.col("valor") > 30)
    assert values(shown) == [(3,)]
    assert sinks.missing_tables(spark, "layers", ["simple", "gone"]) == ["gone"]


def test_restore_a_version_to_a_new_table(spark, frame, values):
    log = frame([(1, "old", "insert", 1, None), (1, "new", "update", 2, None)], "id INT, v STRING, op STRING, version INT, ts TIMESTAMP")
    sinks.write_layer(changes.as_of(log, ["id"], version=1), "layers.restored")
    assert values(spark.table("layers.restored")) == [(1, "old")]


def test_append_and_counts(frame, values):
    df = frame([(1, 2.0)], "k INT, v DOUBLE")
    more = sinks.append_rows(df, [(2, 3.0)])
    assert values(more) == [(1, 2.0), (2, 3.0)]
    assert values(sinks.table_counts({"a": df, "b": more, "none": df.limit(0)})) == [("a", 1), ("b", 2), ("none", 0)]


def test_shared_folder_follows_the_session(spark):
    folder = session.shared_folder(spark)
    assert folder.rstrip("/") == spark.conf.get("spark.checkpoint.dir", folder).rstrip("/")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_insert_update_delete_and_merge_a_table(spark, frame, values):
    sinks.create_table(spark, "layers.ventas", "id STRING, producto STRING, cantidad INT, precio DOUBLE")
    sinks.insert_rows(spark, "layers.ventas", [("1", "Mouse", 2, 10.0), ("3", "USB", 1, 5.0)])
    sinks.insert_rows(spark, "layers.ventas", [("A001", "Torre", 3, 120000.5)])

    def update(df):
        return changes.update_where(df, F.col("id") == "1", {"cantidad": F.lit(5), "precio": F.lit(119000)})

    def delete(df):
        return changes.delete_where(df, F.col("id") == "A001")

    def merge(df):
        news = frame([(3, "Monitor", 1, 179.99), (4, "Impresora", 2, 89.99)], "id INT, producto STRING, cantidad INT, precio DOUBLE")
        return changes.upsert(df, news, ["id"])

    assert [sinks.rewrite_table(spark, "layers.ventas", step) for step in (update, delete, merge)] == [3, 2, 3]
    assert values(spark.table("layers.ventas")) == [
        ("1", "Mouse", 5, 119000.0), ("3", "Monitor", 1, 179.99), ("4", "Impresora", 2, 89.99),
    ]
    assert sinks.missing_tables(spark, "layers", ["ventas", "ventas__next"]) == ["ventas__next"]

    def broken(df):
        return df.withColumn("id", F.raise_error(F.lit("no")).cast("string"))

    with pytest.raises(Exception, match="no"):
        sinks.rewrite_table(spark, "layers.ventas", broken)
    assert spark.table("layers.ventas").count() == 3


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,extra,a\nB1,x,1\nB2,y,no\n")
    df = readers.read_csv(spark, str(tmp_path / "a.csv"), "a INT, b STRING")
    assert df.dtypes == [("a", "int"), ("b", "string")]
    assert [tuple(r) for r in df.collect()] == [(1, "B1"), (None, "B2")]
    with pytest.raises(ValueError, match="no such columns in the header: c"):
        readers.read_csv(spark, str(tmp_path / "a.csv"), "a INT, c STRING")


def test_rewrite_keeps_format_and_partitions(spark, frame, values):
    sinks.write_layer(frame([(1, "x"), (2, "y"), (3, "y")], "k INT, part STRING"), "layers.split", "orc", ["part"])
    assert sinks.rewrite_table(spark, "layers.split", lambda df: df.filter("k <> 2")) == 2
    assert [c.name for c in spark.catalog.listColumns("layers.split") if c.isPartition] == ["part"]
    described = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE TABLE EXTENDED layers.split").collect()}
    assert described["Provider"].lower() == "orc"
    assert values(spark.table("layers.split")) == [(1, "x"), (3, "y")]
    # A job that died before the next state was whole: it is dropped.
    sinks.write_layer(frame([(7, "w")], "k INT, part STRING"), "layers.split__next")
    assert sinks.rewrite_table(spark, "layers.split", lambda df: df.withColumn("k", df["k"] + 1)) == 2
    assert values(spark.table("layers.split")) == [(2, "x"), (4, "y")]
    # A job that died while overwriting: the next call takes the whole state it had stored, and ends there.
    sinks.write_layer(frame([(5, "z"), (6, "z")], "k INT, part STRING"), "layers.split__ready")
    assert sinks.rewrite_table(spark, "layers.split", lambda df: df.filter("k <> 6")) == 2
    assert sinks.rewrite_table(spark, "layers.split", lambda df: df.filter("k <> 6")) == 1
    assert values(spark.table("layers.split")) == [(5, "z")]


def test_rewrite_takes_back_a_table_that_stepped_aside(spark, frame, values):
    sinks.write_layer(frame([(1,), (2,)], "k INT"), "layers.plain__old")
    assert sinks.rewrite_table(spark, "layers.plain", lambda df: df.filter("k = 1")) == 1
    assert values(spark.table("layers.plain")) == [(1,)] and sinks.missing_tables(spark, "layers", ["plain__old"]) == ["plain__old"]

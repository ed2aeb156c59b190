"""Changes of stored files: what is not touched stays, and a failure at any step leaves the old or the new state."""

import os

import pytest
from pyspark.sql import functions as F

from goldseam.operators.changes import delete_where, update_where
from goldseam.sources import files
from goldseam.sources.sinks import rewrite_table

KEYS = ["plain", "a b", "x=1/y%2:z", "ü"]


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(k, KEYS[k % 4], float(k)) for k in range(80)]
    df = spark.createDataFrame(rows, "k int, p string, v double").repartitionByRange(4, "k")
    df.write.partitionBy("p").parquet(path)
    return path


def listed(path):
    """Each data file with its time."""
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet") and "_staged" not in d}


def state(spark, path):
    return sorted(tuple(r) for r in files.read_current(spark, path).select("k", "p", "v").collect())


def test_untouched_files_stay(spark, folder):
    before, rows = listed(folder), state(spark, folder)
    gone = (F.col("p") == KEYS[2]) & (F.col("k") < 20)
    counts = files.change_files(spark, folder, gone, lambda df: delete_where(df, gone), ["p"])
    after = listed(folder)
    assert counts == {"replaced": 1, "kept": len(before) - 1}
    assert len(set(before) - set(after)) == 1 and all(after[f] == t for f, t in before.items() if f in after)
    assert state(spark, folder) == [r for r in rows if not (r[1] == KEYS[2] and r[0] < 20)]
    assert not [n for n in os.listdir(folder) if n.startswith(("_staged", "_change", "_part"))]


def test_rows_may_move_and_nothing_may_be_hit(spark, folder):
    rows, before = state(spark, folder), listed(folder)
    assert files.change_files(spark, folder, F.col("k") < 0, lambda df: df, ["p"])["replaced"] == 0
    assert listed(folder) == before
    hit = F.col("k") == 7
    files.change_files(spark, folder, hit, lambda df: update_where(df, hit, {"p": F.lit("new")}), ["p"])
    assert state(spark, folder) == sorted((k, "new" if k == 7 else p, v) for k, p, v in rows)
    everything = F.lit(True)
    files.change_files(spark, folder, everything, lambda df: delete_where(df, everything), ["p"])
    assert listed(folder) == {}


@pytest.mark.parametrize("step", range(12))
def test_a_failure_at_any_step(spark, folder, monkeypatch, step):
    """The n-th call to the store fails; a repeated call under the same id changes once."""
    old = state(spark, folder)
    hit = F.col("k") % 10 == 3
    new = sorted((k, p, v + 1 if k % 10 == 3 else v) for k, p, v in old)

    def run():
        return files.change_files(spark, folder, hit, lambda df: update_where(df, hit, {"v": F.col("v") + 1}), ["p"], "plus-one")

    class Breaks:
        calls = 0

        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            found = getattr(self.fs, name)
            if name not in ("rename", "delete", "create"):
                return found

            def call(*args):
                Breaks.calls += 1
                if Breaks.calls > step:
                    raise OSError("lost")
                return found(*args)

            return call

    make = files.Folder.__init__

    def init(self, *args):
        make(self, *args)
        self.fs = Breaks(self.fs)

    with monkeypatch.context() as patched:
        patched.setattr(files.Folder, "__init__", init)
        with pytest.raises(OSError, match="lost"):
            run()
    seen = state(spark, folder)
    assert seen in (old, new) and (seen == old) == (step < 2)
    run()
    assert state(spark, folder) == new


@pytest.mark.parametrize("partitioned", [False, True])
@pytest.mark.parametrize("step", range(4))
def test_a_table_is_never_changed_twice(spark, monkeypatch, partitioned, step):
    name = f"layers.prices_{step}_{partitioned}"
    df = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, price double")
    (df.write.partitionBy("k") if partitioned else df.write).mode("overwrite").saveAsTable(name)
    sql, calls = spark.sql, []

    def breaks(text, *args, **kwargs):
        if text.startswith(("ALTER", "DROP")):
            calls.append(text)
            if len(calls) > step:
                raise OSError("lost")
        return sql(text, *args, **kwargs)

    def double(df):
        return df.withColumn("price", F.col("price") * 2)

    with monkeypatch.context() as patched:
        patched.setattr(spark, "sql", breaks)
        try:
            rewrite_table(spark, name, double)
        except OSError:
            pass
    decided = step >= (1 if partitioned else 2)
    finished = step >= (2 if partitioned else 3)
    if not finished:
        rewrite_table(spark, name, double)
    assert sorted(r.price for r in spark.table(name).collect()) == [20.0, 40.0], (decided, calls)
    rewrite_table(spark, name, double)
    assert sorted(r.price for r in spark.table(name).collect()) == [40.0, 80.0]

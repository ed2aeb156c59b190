"""Registered queries against their SQL, and the pipeline stage by stage."""

import pytest
from oracle import connect, differences
from test_llm_jaccard import plain

import __spark_entry__
import corpus_pipeline
from goldseam.llm import ORACLES, QUERIES
from goldseam.llm.common import salted_join
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, name):
    assert differences(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF) == []


def test_registered():
    names = __spark_entry__.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14)) and "pipeline" in names


def test_pipeline(spark, documents):
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        kept[name] = docs
        if name != "tokens":
            assert docs.columns == documents.columns
    near = [(r.doc_id, r.text) for r in kept["toxicity"].collect()]
    assert {r.doc_id for r in kept["near_duplicates"].collect()} == {c for _, _, c in plain(near)}
    assert kept["personal_data"].count() == kept["tokens"].count() == kept["decontamination"].count()
    whole = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == {r.doc_id: r.n_tokens for r in docs.collect()}
    for frame in kept.values():
        frame.unpersist()


def test_salted_join_is_the_plain_one(spark):
    rows = spark.createDataFrame([(k % 7 if k % 3 else 100, k) for k in range(3_000)] + [(None, -1)], "key int, v int")
    sides = rows.where("v >= 0").groupBy("key").agg(F.count("*").alias("n")).where("key <> 3")
    for how in ("inner", "left"):
        salted = salted_join(rows, sides, "key", "n", F.xxhash64("v"), how, salt_rows=10)
        assert sorted(map(str, salted.select("key", "v", "n").collect())) == sorted(map(str, rows.join(sides, "key", how).select("key", "v", "n").collect()))

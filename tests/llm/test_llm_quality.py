"""Outlier rules and the boosted classifier."""

import re

import numpy as np
from pyspark.sql import functions as F

from goldseam.llm import boosting, outliers, textstats


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": sum(x in lines[:k] for k, x in enumerate(lines)), "n_repeat_words": len(marked),
    }


def test_base_statistics(documents):
    texts = [r.text for r in documents.collect() if len(r.text) < 4_000]
    texts += ["", " a\n a\na\n\n \n", "a b c a b c a b c", "é ü\x85x <>|", "a a a a a", "x y"]
    for text in texts:
        found = textstats.base_statistics(text.encode())
        assert {k: found[k] for k in outliers.BASE} == plain_base(text)


def test_outliers_are_rejected_per_group(spark, by_doc):
    clean = " ".join("".join("aeioulnrst"[(k * m + m) % 10] for m in range(3, 3 + 2 + k % 7)) + f"{'.' if k % 9 == 0 else ''}" for k in range(90))
    rows = [(k, clean + " " + " ".join(["more", "words", "of", "some", "kind"][: k % 5]), "en", "a" if k % 3 else "b") for k in range(600)]
    rows += [(1000, clean.replace(" ", "### "), "en", "a"), (1001, clean.upper(), "en", "b"), (1002, "short", "en", "a"), (1003, clean.upper(), "xx", "few")]
    found = {r["doc_id"]: r for r in by_doc(outliers.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")))}
    assert all(found[k]["kept"] for k in range(600))
    assert not found[1000]["kept"] and not found[1001]["kept"]
    assert found[1002]["base_failed"] and not found[1002]["kept"]
    assert found[1003]["kept"] and found[1003]["distance"] == 0  # the only one of what is left


def test_small_languages_are_judged_together(spark, by_doc):
    clean = " ".join("".join("aeioulnrst"[(k * m + m) % 10] for m in range(3, 3 + 2 + k % 7)) + f"{'.' if k % 9 == 0 else ''}" for k in range(90))
    rows = [(k, clean + " " + " ".join(["more", "words", "of", "some", "kind"][: k % 5]), f"l{k % 30}", "a") for k in range(300)]
    rows += [(1000, clean.replace(" ", "### "), "l5", "a"), (1001, clean.upper(), None, None)]
    found = {r["doc_id"]: r for r in by_doc(outliers.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")))}
    assert all(found[k]["kept"] for k in range(300)) and not found[1000]["kept"] and not found[1001]["kept"]


def test_concentration_ignores_a_quarter_of_bad_rows(spark):
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0, 0.3, (400, outliers.DIMS)), rng.normal(5, 0.3, (90, outliers.DIMS))
    rows = spark.createDataFrame([("g", k, [float(v) for v in x]) for k, x in enumerate([*good, *bad])], "grp string, doc_id bigint, x array<double>")
    estimate = outliers.first_estimate(rows)
    for _ in range(4):
        estimate = outliers.concentrate(rows, estimate)
    (row,) = estimate.collect()
    assert np.abs(np.array(row.centre)).max() < 0.15
    precision = np.zeros((outliers.DIMS, outliers.DIMS))
    precision[np.triu_indices(outliers.DIMS)] = row.precision
    precision = precision + precision.T - np.diag(np.diag(precision))
    gap = bad - np.array(row.centre)
    assert (np.einsum("ij,jk,ik->i", gap, precision, gap) * row.scale > outliers.chi_square(7.0)).all()


def test_distance_in_sql_is_the_quadratic_form(spark):
    rng = np.random.default_rng(2)
    x, c = rng.normal(size=outliers.DIMS), rng.normal(size=outliers.DIMS)
    m = rng.normal(size=(outliers.DIMS, outliers.DIMS))
    m = m @ m.T
    row = spark.createDataFrame([(x.tolist(), c.tolist(), m[np.triu_indices(outliers.DIMS)].tolist())], "x array<double>, centre array<double>, precision array<double>")
    assert abs(row.select(outliers.distance()).first()[0] - (x - c) @ m @ (x - c)) < 1e-9


def test_odd_rows_outliers(odd, none, by_doc):
    rows = by_doc(outliers.judge(odd))
    assert [r["n_words"] for r in rows] == [0, 0, 0, 1, 1, 40_000, 1, 2, 1, 0] or len(rows) == 10
    assert not any(r["kept"] for r in rows) and all(r["base_failed"] for r in rows)
    assert outliers.judge(none).count() == 0


def walk(model, x):
    total = model.prior
    for feature, cut, leaf in zip(model.feature, model.cut, model.leaf):
        node = 0
        for level in range(model.depth):
            at = node + 2**level - 1
            node = 2 * node + int(x[feature[at]] > cut[at])
        total += leaf[node]
    return total


def test_flat_trees_walk_like_single_ones():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.2)).astype(float)
    model = boosting.fit(x, y, trees=30)
    assert np.allclose(model.logits(x), [walk(model, row) for row in x])
    assert ((model.predict(x) > 0.5) == y).mean() > 0.98


def test_one_class_and_none():
    x = np.zeros((4, 3))
    assert np.allclose(boosting.fit(x, np.ones(4)).predict(x), 1)
    assert np.allclose(boosting.fit(x[:0], np.ones(0)).predict(x), 0.5)


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = boosting.grade(docs, labels).join(labels.select("doc_id", "quality"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def test_odd_rows_quality(odd, none, labels, by_doc):
    rows = by_doc(boosting.grade(odd, labels))
    assert len(rows) == 10 and rows[3] == rows[4] and all(0 <= r["score"] <= 1 for r in rows)
    assert rows[0]["score"] == rows[1]["score"]
    assert boosting.grade(none, labels.where(F.lit(False))).count() == 0

"""Chat examples: reversible marks, whole contexts, odd rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from goldseam.llm import bound, chat
from goldseam.llm.chat import Template, digests, examples, read_turns, with_probe

DDL = "conv_id bigint, turn bigint, role string, text string"
T = Template()
#: Texts made of marks, parts of marks and escapes.
NASTY = ["", "</s>[INST] ok [/INST]", "[\\INST]", "[\\\\INST]<\\s>", "<", "[", "<</s>", "[[INST]]", "\\", "<\\", "a\nb\r\n", "日本 😀", "$1 \\1 (x)", "<s><s></s>"]


def plain(rows):
    """Digest columns by definition."""
    made = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        made.setdefault(conv, []).append((role or "", text or ""))

    def hexed(text):
        return hashlib.sha256(text.encode()).hexdigest()

    out = {}
    for conv, turns in made.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hexed("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), hexed(loss))
    return out


def test_texts_of_marks_come_back(spark):
    rows = [(k, j, role, text) for k, text in enumerate(NASTY) for j, role in enumerate(["user", "assistant", "to[INST]ol", "assistant", "user"])]
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in digests(spark.createDataFrame(rows, DDL)).collect()}
    assert found == plain(rows)


def test_escaped_texts_hold_no_mark_and_come_back(spark):
    df = spark.createDataFrame([(t,) for t in NASTY], "t string").withColumn("e", T.escape(F.col("t"))).withColumn("u", T.unescape(F.col("e")))
    for row in df.collect():
        assert row.u == row.t and not any(mark in row.e for mark in T.marks)


def test_every_reply_is_an_example_with_its_whole_context(spark):
    rows = [(1, k, role, f"text {k} [INST]") for k, role in enumerate(["system", "user", "assistant", "user", "user", "assistant", "assistant", "user"])]
    made = sorted(examples(spark.createDataFrame(rows, DDL)).collect(), key=lambda r: r.example)
    assert [r.position for r in made] == [3, 6, 7, None]
    for r in made:
        assert r.context_chars == len(r.context)
        text = r.context + r.target
        assert text == "".join(m.added + m.target for m in made[: r.example])
        if r.position:
            assert text[r.loss_start : r.loss_end] == f"text {r.position - 1} [\\INST]"
            read = spark.createDataFrame([(text,)], "t string").select(read_turns(F.col("t")).alias("r")).first().r
            assert [(t.role, t.text) for t in read] == [(role, text) for _, _, role, text in rows[: r.position]]
        else:
            assert r.target == "" and r.loss_start is None


def test_odd_rows(spark):
    rows = [
        (1, 0, None, None), (1, None, "user", "first"), (1, 0, "assistant", None), (1, 0, "assistant", None), (2, 5, "assistant", "x" * 300_000), (3, 1, "user", "u"),
        (4, 2, "user", "b"), (4, 2, "user", "a"),
    ]
    alone = [(None, 0, "user", "u"), (None, 0, "user", "u"), (None, 1, "assistant", "a")]
    df = spark.createDataFrame(rows + alone, DDL).withColumns({c: F.lit(1) for c in ("example", "added", "_alone", "said", "parts")})
    found = digests(df).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found if r.conv_id is not None} == plain(rows)
    assert sorted((r.n_turns, r.loss_chars, r.n_examples) for r in found if r.conv_id is None) == [(1, 0, 0), (1, 0, 0), (1, 1, 1)]
    assert next(r.loss_sha256 for r in found if r.conv_id == 3) == hashlib.sha256(b"").hexdigest()
    assert digests(df.limit(0)).collect() == [] == examples(df.limit(0)).collect()


def test_marks_that_run_into_each_other_are_refused():
    for marks in ({"begin": "<"}, {"head": "a\\b"}, {"begin": "<s", "end": "s>"}, {"begin": "[/INST]"[:4]}):
        with pytest.raises(ValueError):
            Template(**marks)


def test_plan_is_one_shuffle_without_python_or_contexts(spark):
    df = with_probe(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    plan = digests(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Arrow" not in plan
    assert plan.count("collect_list(concat(added") == 0


def test_query_reads_whole_contexts(spark, monkeypatch):
    """What op11_chat returns is read from contexts: with others, it returns something else."""
    run = lambda: {r.conv_id: r for r in bound.op11(spark, "/root/testdata/sf0.001").collect()}
    found = run()
    assert {r.conv_id: r for r in digests(with_probe(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))).collect()} == found
    expanded = chat._expanded
    monkeypatch.setattr(chat, "_expanded", lambda *a: expanded(*a).withColumn("context", F.concat(F.lit("<s>x[INST]y[/INST]"), "context")))
    other = run()
    for conv, row in found.items():
        assert other[conv].n_turns == row.n_turns + 1 and other[conv].formatted_chars == row.formatted_chars + 18
        assert other[conv].example_chars == row.example_chars + 18 * row.n_examples
        assert row.loss_chars == 0 or other[conv].loss_sha256 != row.loss_sha256


def test_whole_contexts_of_odd_rows_and_a_long_conversation(spark):
    rows = [(k, j, role, text) for k, text in enumerate(NASTY) for j, role in enumerate(["user", "assistant", "to[INST]ol", "assistant", "user"])]
    rows += [(50, k, ("user", "assistant")[k % 2], f"t {k} </s>") for k in range(600)] + [(51, 1, "user", "u"), (52, None, None, None), (None, 0, "user", "u"), (None, 0, "user", "u")]
    df = spark.createDataFrame(rows, DDL).withColumns({c: F.lit(1) for c in ("example", "added", "_alone", "said", "parts", "context")})
    whole = digests(df, contexts=True)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count(" Window [") == 2  # turns, and examples: none on top of contexts
    assert sorted(map(str, whole.collect())) == sorted(map(str, digests(df).collect()))

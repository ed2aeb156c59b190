"""Chat formatting by prefix-target expansion: every reply becomes an example of its own, with all turns before it as
context and only that reply trainable. DataFrame functions only.

A turn is written as ``begin role head text`` and closed by ``tail`` if the model reads it, by ``end`` if the model says it.
Roles and texts cannot forge these marks: where a text holds a mark (or what an earlier escape made of one), a
backslash goes after its first character, so ``[INST]`` becomes ``[\\INST]`` and ``[\\INST]`` becomes ``[\\\\INST]``.
Taking one backslash away there gives the text back, whatever it was.

The context of an example is what the examples before it add and say, and what it adds itself. ``examples`` gives it in
full, and ``digests`` reads it on demand; where the column is not used, Spark never makes it, and the work is linear in the
turns of a conversation rather than square. Turns after the last reply are an example without a target, so no turn is lost.

Turns go by ``turn``, ties by role and text; a turn without a number comes first. Repeated rows are repeated turns.
Null texts and roles are empty. A row without a conv_id is a conversation of one turn, since nothing says what belongs
to it. One conversation is sorted by one task, a row at a time; only texts that are results (an example, a digest) must fit
into a row. An empty table gives no examples; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CONVERSATION = ["conv_id", "_alone"]


@dataclass(frozen=True)
class Template:
    begin: str = "<s>"
    head: str = "[INST]"
    tail: str = "[/INST]"
    end: str = "</s>"
    trainable: str = "assistant"

    @property
    def marks(self) -> list[str]:
        return [self.begin, self.head, self.tail, self.end]

    def __post_init__(self) -> None:
        for mark in self.marks:
            if len(mark) < 2 or "\\" in mark:
                raise ValueError(f"a mark has two characters or more and no backslash: {mark!r}")
            for other in self.marks:
                # The end of a text and the mark behind it may not look like an earlier mark.
                if any(other.startswith(mark[k:]) for k in range(1, len(mark))) or (other != mark and mark in other):
                    raise ValueError(f"marks run into each other: {mark!r}, {other!r}")

    @property
    def _escaped(self) -> tuple[str, str]:
        first = "".join(sorted({re.escape(m[0]) for m in self.marks}))
        rest = "|".join(sorted({re.escape(m[1:]) for m in self.marks}))
        return first, rest

    @property
    def turn(self) -> str:
        """Regular expression of one turn: role and text."""
        begin, head, tail, end = map(re.escape, self.marks)
        return f"(?s){begin}(.*?){head}(.*?)(?:{tail}|{end})"

    def escape(self, text: Column) -> Column:
        first, rest = self._escaped
        return F.regexp_replace(text, rf"([{first}])(?=\\*(?:{rest}))", r"$1\\")

    def unescape(self, text: Column) -> Column:
        first, rest = self._escaped
        return F.regexp_replace(text, rf"([{first}])\\(?=\\*(?:{rest}))", r"$1")

    def opened(self, role: Column) -> Column:
        return F.concat(F.lit(self.begin), self.escape(role), F.lit(self.head))


def _turns(conversations: DataFrame, template: Template) -> DataFrame:
    """One row per turn: its place in the conversation, its example, its text and where its characters begin."""
    rows = conversations.select(
        "conv_id",
        # Depends on the row's place in the input only, which a task that runs again reads in the same order.
        F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("_alone"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    said = F.col("role") == template.trainable
    opened, inner = template.opened(F.col("role")), template.escape(F.col("text"))
    rows = rows.withColumns({"said": said, "_opened": F.char_length(opened), "_inner": F.char_length(inner)})
    rows = rows.withColumn("piece", F.concat(opened, inner, F.when(said, F.lit(template.end)).otherwise(F.lit(template.tail))))
    order = Window.partitionBy(*CONVERSATION).orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        *CONVERSATION, "said", "piece", "_opened", "_inner",
        F.row_number().over(order).alias("position"),
        (F.coalesce(F.sum(said.cast("int")).over(before), F.lit(0)) + 1).alias("example"),
        F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)).alias("_start"),
    )


def _expanded(conversations: DataFrame, template: Template) -> DataFrame:
    """The examples, with the key of their conversation. All steps keep the partitioning of the first."""
    made = _turns(conversations, template).groupBy(*CONVERSATION, "example").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(~F.col("said"), F.struct("position", "piece")))), lambda t: t["piece"]), "").alias("added"),
        F.coalesce(F.max(F.when(F.col("said"), F.col("piece"))), F.lit("")).alias("target"),
        F.max(F.when(F.col("said"), F.col("position"))).alias("position"),
        F.max(F.when(F.col("said"), F.col("_start") + F.col("_opened"))).alias("loss_start"),
        F.max(F.when(F.col("said"), F.col("_start") + F.col("_opened") + F.col("_inner"))).alias("loss_end"),
        F.min("_start").alias("_from"),
    )
    order = Window.partitionBy(*CONVERSATION).orderBy("example")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    context = F.concat(F.array_join(F.collect_list(F.concat("added", "target")).over(earlier), ""), F.col("added"))
    # In the same window as the contexts: a window on top of them would hold all contexts of a conversation.
    last = F.lead("example").over(order).isNull()
    return made.withColumns({"context_chars": F.col("_from") + F.char_length("added"), "context": context, "last": last})


def examples(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, example (from 1), position (of the reply; null where only context is left), added, target, context,
    context_chars, loss_start, loss_end.

    The text of an example is ``context`` and ``target``; of it only the characters from ``loss_start`` (from 0) to
    ``loss_end`` (exclusive) are trained: the reply's text without marks. ``added`` is what the context has beyond the example before.
    """
    columns = ["conv_id", "example", "position", "added", "target", "context", "context_chars", "loss_start", "loss_end"]
    return _expanded(conversations, template).select(*columns)


def read_turns(text: Column, template: Template = Template()) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    roles, texts = (F.regexp_extract_all(text, F.lit(template.turn), F.lit(group)) for group in (1, 2))
    plain = template.unescape
    return F.zip_with(roles, texts, lambda r, t: F.struct(plain(r).alias("role"), plain(t).alias("text")))


def digests(conversations: DataFrame, template: Template = Template(), contexts: bool = False) -> DataFrame:
    """Per conversation, read back from its examples: its turns, what is trained, and characters.

    ``formatted_chars`` counts each turn once, ``example_chars`` all texts of all examples. With ``contexts`` every example
    is made and read in full: what is trained comes from its context and target, and the turns from the last example, which
    holds them all. That is the work of writing the examples, square in the turns of a conversation, one example in memory
    at a time. Without, each is read as what it adds to the one before.
    """
    made = _expanded(conversations, template)
    text = F.concat("context" if contexts else "added", "target")
    begins = F.lit(0) if contexts else F.col("context_chars") - F.char_length("added")
    trained = F.substring(text, F.col("loss_start") - begins + 1, F.col("loss_end") - F.col("loss_start"))
    chars, turns = F.char_length(text), read_turns(text, template)
    if contexts:
        turns = F.when(F.col("last"), turns).otherwise(F.array().cast(made.select(turns).schema[0].dataType))
    read = made.select(
        *CONVERSATION, "example",
        turns.alias("turns"),
        F.coalesce(template.unescape(trained), F.lit("")).alias("loss"),
        (F.when(F.col("last"), chars).otherwise(0) if contexts else chars).alias("chars"),
        F.col("position").isNotNull().cast("int").alias("reply"),
        (chars if contexts else F.col("context_chars") + F.char_length("target")).alias("whole"),
    )
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = read.select(*CONVERSATION, "example", F.size("turns").alias("n"), line.alias("line"), "loss", "chars", "reply", "whole")
    parts = F.sort_array(F.collect_list(F.struct("example", "line", "loss")))
    found = read.groupBy(*CONVERSATION).agg(
        F.sum("n").alias("n_turns"), parts.alias("parts"), F.sum(F.char_length("loss")).alias("loss_chars"), F.sum("chars").alias("formatted_chars"),
        F.sum("reply").alias("n_examples"), F.sum(F.when(F.col("reply") == 1, F.col("whole")).otherwise(0)).alias("example_chars"),
    )

    def digest(field: str) -> Column:
        return F.sha2(F.array_join(F.transform("parts", lambda p: p[field]), ""), 256)

    return found.select(
        "conv_id", "n_turns", digest("line").alias("turns_sha256"), "loss_chars", digest("loss").alias("loss_sha256"),
        "formatted_chars", "n_examples", "example_chars",
    )


def with_probe(conversations: DataFrame) -> DataFrame:
    """``conversations`` and conversation -1, whose texts consist of marks."""
    text = "</s>[INST] ok [/INST]"
    spark = conversations.sparkSession
    probe = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id int, turn int, role string, text string")
    kinds = {f.name: f.dataType for f in conversations.schema.fields}
    return conversations.select(*probe.columns).union(probe.select(*(F.col(c).cast(kinds[c]) for c in probe.columns)))


def digests_sql() -> str:
    """``digests`` of the table and the probe, with the default template, in DuckDB's SQL."""
    rest = r"(s>|INST\]|/INST\]|/s>)"
    escaped = rf"length(regexp_replace({{0}}, '([<\[])(\\*){rest}', '\1\\\2\3', 'g'))"
    return f"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), c AS (
        SELECT *, 9 + {escaped.format("role")} + {escaped.format("text")} + CASE role WHEN 'assistant' THEN 4 ELSE 7 END AS chars,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place
        FROM t
    ), w AS (
        SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY place) AS whole FROM c
    )
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(chars) AS BIGINT) AS formatted_chars, count(*) FILTER (WHERE role = 'assistant') AS n_examples,
           CAST(coalesce(sum(whole) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS example_chars
    FROM w GROUP BY conv_id
    """

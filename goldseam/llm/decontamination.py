"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Texts become words in which numbers, names and units are typed placeholders: a number is any run of
digits (with inner dots and commas), a unit a known word after a number, a name a capitalised word
after a lower-case word, a digit, a comma, a semicolon or a colon and a space. Every other word is lower-cased. So a question
with other numbers and names has the same template. Windows of ``window`` template words of each document are hash-joined with
those of the benchmark's items. A shorter text is one window by itself.

A match at a fixed distance between document and item is an alignment. In an alignment the values behind
the placeholders must be consistent: where the item repeats a value, the document repeats
its own. A document contains an item if consistent alignments cover at least ``coverage`` of the item's windows.

The benchmark's windows are broadcast if there are at most ``broadcast_rows`` of them (some 50
bytes each); otherwise both sides are shuffled by the window's hash, the documents' most common
windows salted. Documents' windows are never gathered, only matches are grouped, by document and item.

Null texts have no words and contain nothing. Documents without an id are looked at as one under the
null id by ``contamination``, as in the SQL; ``decontaminate`` judges every row by its own text; repeated rows count as one document. Items of equal text are all reported. An empty benchmark
matches nothing. Items shorter than the window are only found as whole documents, as in the SQL; with
``short_items`` documents also get windows of the lengths that such items have, and they are found inside longer documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldseam.llm.common import salted_join

#: Private-use characters open a placeholder's word: number, unit, name. Texts' own ones become blanks.
NUMBER, UNIT, NAME, AFTER = "", "", "", ""

#: Units, matched in any case.
UNITS = (
    "kilometers?|kilometres?|km|meters?|metres?|centimeters?|cm|millimeters?|mm|miles?|feet|foot|ft|inches|inch|yards?|"
    "kilograms?|kg|grams?|mg|g|pounds?|lbs?|ounces?|oz|liters?|litres?|ml|l|gallons?|"
    "hours?|hrs?|h|minutes?|mins?|seconds?|secs?|s|days?|weeks?|months?|years?|"
    "dollars?|cents?|euros?|usd|eur|percent|degrees?|mph|kmh"
)

#: Replacements that make the template, in order; rules for neighbours that share a character run twice.
RULES = [
    (r"([0-9])[.,]([0-9])", "$1_$2"),
    (r"([0-9])[.,]([0-9])", "$1_$2"),
    (r"([0-9][0-9_]*)", f" {NUMBER}$1 "),
    (rf"({NUMBER}[0-9_]+ +)((?i:{UNITS}))([^\p{{L}}]|$)", f"$1 {UNIT}$2$3"),
    (r"([\p{Ll}0-9,;:] )(\p{Lu}\p{Ll}+)", f"$1{NAME}$2"),
    (r"([\p{Ll}0-9,;:] )(\p{Lu}\p{Ll}+)", f"$1{NAME}$2"),
]
SEPARATORS = rf"[^\p{{L}}\p{{M}}0-9_{NUMBER}{UNIT}{NAME}]+"


def words_of(text: Column) -> Column:
    """Words of the text; those that stand for a value begin with a placeholder character."""
    made = F.translate(F.coalesce(text, F.lit("")), NUMBER + UNIT + NAME, "   ")
    for pattern, replacement in RULES:
        made = F.regexp_replace(made, pattern, replacement)
    return F.filter(F.split(F.lower(made), SEPARATORS), lambda w: w != "")


def _placeholder(word: Column) -> Column:
    return (word >= NUMBER) & (word < AFTER)


def windows(texts: DataFrame, key: str, window: int, short: list[int] | None = None) -> DataFrame:
    """key, n (windows of the text), at, hash, and slots: the values behind the window's placeholders (null without any).

    With ``short``, the windows of those numbers of words as well, for every text that has them.
    """
    words = texts.select(F.col(key), words_of(F.col("text")).alias("words"))
    template = F.transform("words", lambda w: F.xxhash64(F.when(_placeholder(w), F.left(w, F.lit(1))).otherwise(w)))
    marked = words.withColumn("codes", template).withColumn("slotted", F.exists("words", _placeholder))

    def at(i: Column, length: int) -> Column:
        missing = [F.lit(None).cast("bigint")] * (window - length)
        code = F.xxhash64(*(F.get("codes", i + k) for k in range(length)), *missing)
        inside = F.filter(F.slice("words", i + 1, length), _placeholder)
        slots = F.when(F.col("slotted"), F.when(F.size(inside) > 0, inside))
        return F.struct(i.alias("at"), code.alias("hash"), slots.alias("slots"))

    def of(length: int):
        return lambda i: at(i, length)

    # A text of fewer words is one window; missing words hash as nulls, so lengths stay apart.
    n = F.greatest(F.size("words") - (window - 1), F.lit(1))
    made = F.when(F.size("words") > 0, F.transform(F.sequence(F.lit(0), n - 1), of(window)))
    for length in short or []:
        # A text of just as many words has that window already.
        some = F.transform(F.sequence(F.lit(0), F.size("words") - length), of(length))
        made = F.when(F.size("words") > length, F.concat(made, some)).otherwise(made)
    # The outer form keeps the optimizer from computing all of the above once more to filter empty texts early.
    exploded = marked.select(key, n.alias("n"), F.explode_outer(made).alias("w")).where(F.col("w").isNotNull())
    return exploded.select(key, "n", F.col("w")["at"].alias("at"), F.col("w")["hash"].alias("hash"), F.col("w")["slots"].alias("slots"))


def contamination(
    docs: DataFrame, items: DataFrame, window: int = 8, coverage: float = 0.5, broadcast_rows: int = 1_000_000, short_items: bool = False
) -> DataFrame:
    """doc_id, item_id, n_windows (of the item, covered), item_windows of every document that contains an item."""
    asked = windows(items.select("item_id", "text"), "item_id", window).select(
        "item_id", F.col("n").alias("item_windows"), F.col("at").alias("item_at"), "hash", F.col("slots").alias("item_slots")
    )
    short = []
    if short_items:
        n = F.size(words_of(F.col("text"))).alias("n")
        short = sorted(r["n"] for r in items.select(n).where((F.col("n") > 0) & (F.col("n") < window)).distinct().collect())
    seen = windows(docs.select("doc_id", "text"), "doc_id", window, short).select("doc_id", "at", "hash", "slots")
    if asked.limit(broadcast_rows + 1).count() <= broadcast_rows:
        hits = seen.join(F.broadcast(asked), "hash")
    else:
        rows = seen.groupBy("hash").agg(F.count("*").alias("rows"))
        hits = salted_join(seen, asked.join(rows, "hash"), "hash", "rows", F.xxhash64("doc_id", "at")).drop("rows")
    pairs = F.zip_with("item_slots", "slots", lambda i, d: F.struct(i.alias("i"), d.alias("d")))
    aligned = hits.groupBy("doc_id", "item_id", "item_windows", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.collect_set("item_at").alias("covered"),
        F.array_distinct(F.flatten(F.collect_set(F.when(F.col("item_slots").isNotNull(), pairs)))).alias("values"),
    )
    items_values = F.array_distinct(F.transform("values", lambda v: v["i"]))
    consistent = aligned.where(F.size("values") == F.size(items_values))
    covered = consistent.groupBy("doc_id", "item_id", "item_windows").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("covered")))).alias("n_windows")
    )
    return covered.where(F.col("n_windows") >= coverage * F.col("item_windows")).select(
        "doc_id", "item_id", F.col("n_windows").cast("long").alias("n_windows"), F.col("item_windows").cast("long").alias("item_windows")
    )


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text contains an item. Rows are told apart by their text, never by an id that
    other rows may share or lack."""
    key = F.unhex(F.sha2("text", 256))  # null for a null text, which contains nothing
    texts = docs.select(key.alias("doc_id"), "text")
    found = contamination(texts, items, **options).select(F.col("doc_id").alias("_found")).distinct()
    return docs.join(found, F.unhex(F.sha2(docs["text"], 256)) == found["_found"], "left_anti")


def _sql_words(text: str) -> str:
    """The same words in DuckDB's SQL."""
    made = f"translate(coalesce({text}, ''), '{NUMBER}{UNIT}{NAME}', '   ')"
    for pattern, replacement in RULES:
        made = f"regexp_replace({made}, '{pattern}', '{replacement.replace('$', chr(92))}', 'g')"
    return f"list_filter(regexp_split_to_array(lower({made}), '{SEPARATORS}'), lambda w: w <> '')"


def contamination_sql(window: int = 8, coverage: float = 0.5) -> str:
    def side(source: str, key: str) -> str:
        return f"""
        SELECT {key}, n, unnest(range(n)) AS pos, words FROM (
            SELECT {key}, words, greatest(len(words) - {window - 1}, 1) AS n
            FROM (SELECT {key}, {_sql_words('text')} AS words FROM {source}) WHERE len(words) > 0)
        """

    template = f"list_transform(words[pos + 1 : pos + {window}], lambda w: CASE WHEN w >= '{NUMBER}' AND w < '{AFTER}' THEN w[1] ELSE w END)"
    slots = f"list_filter(words[pos + 1 : pos + {window}], lambda w: w >= '{NUMBER}' AND w < '{AFTER}')"
    return f"""
    WITH d AS (SELECT doc_id, pos, {template} AS t, {slots} AS s FROM ({side('documents', 'doc_id')})),
    i AS (SELECT item_id, n AS item_windows, pos AS item_pos, {template} AS t, {slots} AS item_s FROM ({side('benchmark', 'item_id')})),
    hits AS (
        SELECT doc_id, item_id, item_windows, pos - item_pos AS shift, item_pos, s, item_s FROM d JOIN i USING (t)
    ), slots AS (
        SELECT DISTINCT doc_id, item_id, shift, unnest(item_s) AS iv, unnest(s) AS dv FROM hits
    ), broken AS (
        SELECT DISTINCT doc_id, item_id, shift FROM slots GROUP BY doc_id, item_id, shift, iv HAVING count(*) > 1
    )
    SELECT doc_id, item_id, count(DISTINCT item_pos) AS n_windows, CAST(item_windows AS BIGINT) AS item_windows
    FROM hits ANTI JOIN broken USING (doc_id, item_id, shift)
    GROUP BY doc_id, item_id, item_windows
    HAVING count(DISTINCT item_pos) >= {coverage} * item_windows
    """

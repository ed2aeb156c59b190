"""Personal data by weak supervision, in DataFrame functions only.

Base spans (email, ip, card, phone) are what fixed patterns find and fixed checks pass; they always stay. Beyond
them, wider patterns propose candidates: long codes, dashed and grouped numbers, phone numbers
without a country, runs of capitalised words. Labelers vote on each: patterns on its shape, word lists
on its words, and context on the words before it; a labeler says yes, no, or abstains. Expectation
maximisation over the counts of vote patterns (3 to the number of labelers at most, so they
fit the driver however many candidates there are) estimates how often each labeler votes which way on personal and
other candidates, and with that every pattern's probability. These probabilities train the final span
classifier, a naive Bayes over features of the span and the words before it, again from counts. Its
weights go into the last projection as a literal map.

Patterns are read once: spans and candidates of each document are stored, training and the final
projection read that small table. A document's spans stay in its row, so no document and no group is gathered.

Null texts count as empty. Repeated rows are treated alike; a null doc_id is kept. With no
candidates nothing is added. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldseam.llm.common import stored

#: Marks matches inside a text; where a text itself has it, another control character stands in.
MARK, STAND_IN = "\x01", "\x02"

#: Base kinds in their order. Matches can only begin where a run of their first
#: characters begins or the last match ended, so looking back changes no match and keeps scanning linear;
#: possessive repeats do the same. The card pattern already asks for 16 to 19 digits.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![0-9])(?![ -][0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
BASE_KINDS = ("email", "ip", "card", "phone")

#: Candidate patterns and the kind each proposes.
CANDIDATES = {
    "secret": r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{20,}+=*+",
    "id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])|(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "local_phone": r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])",
    "person": r"(?<![\p{L}])\p{Lu}\p{Ll}{1,30}(?: \p{Lu}\p{Ll}{1,30}){1,2}(?![\p{L}])",
}
ADDED_KINDS = tuple(CANDIDATES)
CONTEXT = 24
#: Matches or spans that are summed or joined at a time.
BLOCK = 64

#: Word lists.
TITLES = r"(?i)(?:^|[^\p{L}])(?:mr|mrs|ms|dr|prof|herr|frau|señora?|sra?|monsieur|madame|mme)\.? *$"
GIVEN_NAMES = (
    r"^(?:Anna|Maria|Marie|John|James|Robert|Michael|David|Mary|Linda|Susan|Peter|Paul|Thomas|Hans|Klaus|Julia|Laura|"
    r"Carlos|José|Juan|Luis|Carmen|Sofia|Pierre|Jean|Claire|Camille|Nicolas|Sarah|Daniel|Alice|Emma|Max|Karl|Eva)\b"
)
SECRET_WORDS = r"(?i)(?:token|secret|password|passwd|pwd|api[ _-]?key|access[ _-]?key|credential|bearer)[\"']?\s*(?:[:=]|is)?\s*[\"']?$"
ID_WORDS = r"(?i)(?:ssn|social security(?: number)?|iban|passport|account(?: number)?|tax id|id)\s*(?:[:=#]|is|no\.?)?\s*$"
PHONE_WORDS = r"(?i)(?:tel|phone|telephone|mobile|call|fax|teléfono|téléphone|telefon)\.?\s*(?:[:=#]|is|at)?\s*$"
HARMLESS_WORDS = r"(?i)(?:commit|sha|sha1|sha256|md5|checksum|digest|hash|uuid|isbn|version|build|revision|order|item|figure|table|chapter)[\"']?\s*[:=#]?\s*[\"']?$"

#: Labelers: when each says yes, and when no, of a candidate struct.
LABELERS = {
    "shape_code": (
        lambda c: c["value"].rlike(r"^[0-9a-fA-F]{32,}$") | c["value"].rlike(r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9_+/-]{24,}={0,2}$"),
        lambda c: (c["kind"] == "secret") & c["value"].rlike(r"^[\p{L}_/+-]*$"),
    ),
    "shape_number": (
        lambda c: c["kind"].isin("id", "local_phone"),
        lambda c: (c["kind"] == "id") & c["value"].rlike("^(?:000|666|9[0-9][0-9])-"),
    ),
    "shape_mixed": (
        lambda c: (c["kind"] == "secret") & c["value"].rlike("[0-9].*[A-Za-z].*[0-9].*[A-Za-z].*[0-9]"),
        lambda c: (c["kind"] == "secret") & c["value"].rlike("/.*/|--|__|[-_/+][a-z]+[-_/+]"),
    ),
    "list_names": (
        lambda c: (c["kind"] == "person") & c["value"].rlike(GIVEN_NAMES),
        lambda c: (c["kind"] == "person") & c["left"].rlike("(?:^|[.!?\n] *)$"),
    ),
    "context_title": (
        lambda c: (c["kind"] == "person") & c["left"].rlike(TITLES),
        lambda c: (c["kind"] == "person") & ~c["left"].rlike(r"[\p{L},:;] $"),
    ),
    "context_words": (lambda c: _telling(c["left"]), lambda c: c["left"].rlike(HARMLESS_WORDS)),
}

#: Features of the final classifier, of a candidate struct.
FEATURES = {
    "kind": lambda c: c["kind"],
    "size": lambda c: F.least(F.lit(8), F.floor(F.char_length(c["value"]) / 8)).cast("string"),
    "digits": lambda c: F.floor(4 * F.char_length(_digits(c["value"])) / F.char_length(c["value"])).cast("string"),
    "letters": lambda c: F.concat(
        F.when(c["value"].rlike("[a-z]"), "a").otherwise(""), F.when(c["value"].rlike("[A-Z]"), "A").otherwise("")
    ),
    "before": lambda c: F.when(c["left"].rlike("[:=] *[\"']?$"), "assigned")
    .when(c["left"].rlike("[\"']$"), "quoted")
    .when(c["left"].rlike("[0-9A-Za-z] *$"), "word")
    .otherwise("other"),
    "words": lambda c: F.when(c["left"].rlike(HARMLESS_WORDS), "harmless").when(_telling(c["left"]), "telling").otherwise("none"),
}


def _telling(left: Column) -> Column:
    return left.rlike(SECRET_WORDS) | left.rlike(ID_WORDS) | left.rlike(PHONE_WORDS) | left.rlike(TITLES)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _blocks(items: Column) -> Column:
    """Numbers of the blocks of an array that is not empty."""
    return F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))


def _block_starts(lengths: Column) -> Column:
    """For every block of lengths, the sum of all before it."""
    start = F.struct(F.lit(0).alias("at"), F.array().alias("starts")).cast("struct<at:int,starts:array<int>>")

    def step(state: Column, block: Column) -> Column:
        end = state["at"] + _sum(F.slice(lengths, block * BLOCK + 1, F.lit(BLOCK)))
        return F.struct(end.alias("at"), F.concat(state["starts"], F.array(state["at"])).alias("starts"))

    return F.aggregate(_blocks(lengths), start, step, lambda state: state["starts"])


def matches(text: Column, pattern: str, context: int = 0) -> Column:
    """All matches as structs of begin, end, value and the ``context`` code points before.

    The matches are marked, and the text cut at the marks: every second piece is a match, and the sum of the lengths
    before gives its place, taken by blocks so that many matches cost little more each than one. A match holds no mark, as
    no pattern takes that character.
    """
    marked = F.split(F.regexp_replace(text, F.lit(f"({pattern})"), F.lit(f"{MARK}$1{MARK}")), MARK)

    def placed(pieces: Column, lengths: Column, starts: Column) -> Column:
        def match(k: Column) -> Column:
            inside = k % BLOCK
            begin = F.element_at(starts, ((k - inside) / BLOCK).cast("int") + 1) + _sum(F.slice(lengths, k - inside + 1, inside))
            left = F.right(F.element_at(pieces, k), F.lit(context)) if context else F.lit("")
            end = begin + F.element_at(lengths, k + 1)
            return F.struct(begin.alias("begin"), end.alias("end"), F.element_at(pieces, k + 1).alias("value"), left.alias("left"))

        return F.transform(F.sequence(F.lit(1), F.size(pieces) - 1, F.lit(2)), match)

    def found(pieces: Column) -> Column:
        lengths = F.transform(pieces, F.char_length)
        some = _bound(lengths, lambda n: _bound(_block_starts(n), lambda starts: placed(pieces, n, starts)))
        none = F.array().cast("array<struct<begin:int,end:int,value:string,left:string>>")
        return F.when(F.size(pieces) > 1, some).otherwise(none)

    return _bound(marked, found)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits, every second one from the right doubled and its digits added, sum to a multiple of ten."""
    digits = F.filter(F.split(F.reverse(_digits(value)), ""), lambda d: d != "")
    parts = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(parts, F.lit(0), lambda a, b: a + b) % 10 == 0


def _of_kind(kind: str, spans: Column, *fields: str) -> Column:
    """Spans as structs of kind and fields."""
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), *(s[c].alias(c) for c in fields or ("begin", "end"))))


def all_of(base: bool = True, added: bool = True) -> Column:
    """Structs of kind, begin, end by kind as listed, then begin."""
    spans = [_of_kind(kind, F.col(kind)) for kind in BASE_KINDS if base]

    def only(kind: str) -> Column:
        return _of_kind(kind, F.filter("_taken", lambda c: c["kind"] == kind))

    return F.concat(*spans, *(only(kind) for kind in ADDED_KINDS if added))


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each base kind; a pattern is only tried where a text has what its matches cannot do without."""
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
    none = F.array().cast("array<struct<begin:int,end:int,value:string,left:string>>")

    def found(needs: str, pattern: str, check) -> Column:
        spans = matches(text, pattern)
        return F.when(text.rlike(needs), F.filter(spans, check) if check else spans).otherwise(none)

    return {
        "email": found("@", EMAIL, None),
        "ip": found(r"[0-9]\.[0-9]", IP, lambda s: s["value"].rlike(rf"^{part}(?:\.{part}){{3}}$")),
        "card": found(r"[0-9](?:[ -]?[0-9]){15}", CARD, lambda s: _luhn(s["value"])),
        "phone": found(r"\+[0-9]", PHONE, lambda s: F.char_length(_digits(s["value"])).between(8, 15)),
    }


def clean(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), MARK, STAND_IN)


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with an array of spans per base kind, and ``candidates``: structs of kind, begin, end, value, left."""
    rows = docs.withColumn("_text", clean(F.col("text")))
    rows = rows.withColumns(base_spans(F.col("_text")))
    proposed = [_of_kind(kind, matches(F.col("_text"), pattern, CONTEXT), "begin", "end", "value", "left") for kind, pattern in CANDIDATES.items()]
    rows = rows.withColumn("candidates", F.concat(*proposed))
    base = F.concat(*(F.col(kind) for kind in BASE_KINDS))
    free = F.filter("candidates", lambda c: ~F.exists(base, lambda b: (b["begin"] < c["end"]) & (c["begin"] < b["end"])))
    return rows.withColumn("candidates", free).drop("_text")


def reliabilities(patterns: dict[str, float], rounds: int = 50) -> tuple[float, list[dict[str, tuple[float, float]]], dict[str, float]]:
    """Expectation maximisation: share of personal candidates, each labeler's vote rates on (other,
    personal) ones, and the probability of each pattern. Starts from the majority of votes; rates are
    smoothed by one count, so that no vote ever decides alone."""
    width = len(next(iter(patterns), ""))
    total = sum(patterns.values())
    chance = {p: (1 + p.count("y")) / (2 + p.count("y") + p.count("n")) for p in patterns}
    share, rates = 0.5, []
    for _ in range(rounds):
        personal = sum(patterns[p] * chance[p] for p in sorted(patterns))
        share = (personal + 1) / (total + 2)
        rates = []
        for k in range(width):
            seen = {v: [1.0, 1.0] for v in "yn-"}
            # A yes is taken to speak for personal data: one pseudo count on the right side.
            seen["y"][1] += 1
            seen["n"][0] += 1
            for p, n in sorted(patterns.items()):
                seen[p[k]][0] += n * (1 - chance[p])
                seen[p[k]][1] += n * chance[p]
            sums = [sum(c[side] for c in seen.values()) for side in (0, 1)]
            rates.append({v: (c[0] / sums[0], c[1] / sums[1]) for v, c in seen.items()})
        for p in patterns:
            odds = math.log(share / (1 - share)) + sum(math.log(rates[k][v][1] / rates[k][v][0]) for k, v in enumerate(p))
            chance[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return share, rates, chance


def train(found: DataFrame) -> tuple[float, dict[str, float]]:
    """The classifier as a bias and a weight per feature value, from counts of (votes, features)."""
    names = list(FEATURES)
    c = F.col("c")
    votes = [F.when(yes(c), "y").when(no(c), "n").otherwise("-") for yes, no in LABELERS.values()]
    counts = (
        found.select(F.explode("candidates").alias("c"))
        .select(F.concat(*votes).alias("votes"), *(feature(c).alias(name) for name, feature in FEATURES.items()))
        .groupBy("votes", *names)
        .agg(F.count("*").alias("n"))
        .collect()
    )
    if not counts:
        return -math.inf, {}
    patterns: dict[str, float] = {}
    for row in counts:
        patterns[row["votes"]] = patterns.get(row["votes"], 0) + row["n"]
    share, _, chance = reliabilities(patterns)
    sums: dict[tuple[str, str], list[float]] = {}
    totals = [0.0, 0.0]
    for row in counts:
        personal = row["n"] * chance[row["votes"]]
        for side, n in enumerate((row["n"] - personal, personal)):
            totals[side] += n
            for name in names:
                sums.setdefault((name, row[name]), [0.0, 0.0])[side] += n
    values = {name: len({v for n, v in sums if n == name}) for name in names}
    weights = {
        f"{name}={value}": math.log((n[1] + 0.5) / (totals[1] + 0.5 * values[name]))
        - math.log((n[0] + 0.5) / (totals[0] + 0.5 * values[name]))
        for (name, value), n in sums.items()
    }
    return math.log((totals[1] + 1) / (totals[0] + 1)), weights


def _accepted(bias: float, weights: dict[str, float]) -> Column:
    """The candidates that the classifier takes; feature values it has not met weigh nothing."""
    if not weights:
        return F.filter("candidates", lambda c: F.lit(False))
    table = F.create_map(*(F.lit(x) for k in sorted(weights) for x in (k, float(weights[k]))))

    def score(c: Column) -> Column:
        total = F.lit(float(bias))
        for name, feature in FEATURES.items():
            total = total + F.coalesce(F.try_element_at(table, F.concat(F.lit(f"{name}="), feature(c))), F.lit(0.0))
        return total > 0

    return F.filter("candidates", score)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, ``base`` and ``added``: arrays of (kind, begin, end) by kind as listed, then begin."""
    found = stored(find(docs.select("doc_id", "text")).drop("text"), "pii-spans")
    taken = _accepted(*train(found))
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.withColumn("_taken", taken).select("doc_id", *counts, all_of(added=False).alias("base"), all_of(base=False).alias("added"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans (base and added) of every whole text."""
    rows = detect(docs)
    spans = _listed(F.concat("base", "added"))
    counts = [f"n_{kind}" for kind in BASE_KINDS]
    whole = (F.size("base") + F.size("added")).cast("bigint").alias("n_spans")
    return rows.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), spans.alias("spans"), whole)


def _replaced(text: Column, order: Column) -> Column:
    """``text`` with spans (begin, back, kind; at least one) replaced, by blocks: what is cut and joined is small each time."""
    shape = "struct<at:int,parts:array<string>>"
    none = F.array().cast("array<string>")

    def block(state: Column, number: Column) -> Column:
        spans = F.slice(order, number * BLOCK + 1, F.lit(BLOCK))
        last = F.array_max(F.transform(spans, lambda s: -s["back"]))
        # The stretch of text that this block of spans takes.
        stretch = F.substring(text, state["at"] + 1, F.greatest(last - state["at"], F.lit(0)))

        def within(cut: Column) -> Column:
            def step(inner: Column, s: Column) -> Column:
                between = F.substring(cut, inner["at"] - state["at"] + 1, s["begin"] - inner["at"])
                named = F.concat(F.lit("["), s["kind"], F.lit("]"))
                more = F.struct((-s["back"]).alias("at"), F.concat(inner["parts"], F.array(between, named)).alias("parts"))
                return F.when(s["begin"] >= inner["at"], more.cast(shape)).otherwise(inner)

            return F.aggregate(
                spans, F.struct(state["at"].alias("at"), none.alias("parts")).cast(shape), step,
                lambda inner: F.struct(inner["at"].alias("at"), F.concat(state["parts"], F.array(F.array_join(inner["parts"], ""))).alias("parts")),
            )

        return _bound(stretch, within)

    start = F.struct(F.lit(0).alias("at"), none.alias("parts")).cast(shape)
    rest = lambda state: F.substring(text, state["at"] + 1, F.char_length(text))
    return F.aggregate(_blocks(order), start, block, lambda state: F.concat(F.array_join(state["parts"], ""), rest(state)))


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets, and n_chars brought up to date if there.

    The spans are found again in the pass that replaces them, so rows need no key and no join; only
    the training counts come from a pass before. Of overlapping spans the one that begins first stays,
    of those the longest. Null texts stay null.
    """
    taken = _accepted(*train(stored(find(docs.select("text")).select("candidates"), "pii-candidates")))
    columns = [c for c in docs.columns]
    # Found under names of our own, as the table may have columns of any name.
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), F.col("text"))
    found = find(own).withColumn("_taken", taken)
    spans = all_of()
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    masked = _bound(order, lambda ordered: _replaced(F.col("text"), ordered))
    changed = F.when(F.size(spans) > 0, masked).otherwise(F.col("text"))
    result = found.select("row", changed.alias("_masked"))
    values = {"text": F.col("_masked"), "n_chars": F.when(F.col("_masked").isNull(), F.col("row")["n_chars"] if "n_chars" in columns else None).otherwise(F.char_length("_masked"))}
    kinds = dict(docs.dtypes)
    return result.select(*(values[c].cast(kinds[c]).alias(c) if c in values else F.col("row")[c].alias(c) for c in columns))

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from goldseam.llm import pii


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def test_base_spans(spark, documents):
    draw = random.Random(3)
    texts = [
        "a@b.c_d@e.f x..y@z.q.w", "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.255", "4111 1111 1111 1111 1234 4111-1111-1111-1111",
        "+1 (017) 555-7713 +12 +1234567890123456", "日本a@b.cd 4111111111111111😀+49 30 1234567\x01q@w.er",
        "a" * 50_000 + " 5", "1" * 30_000, "a@b" + ".c" * 20_000, "",
    ]
    texts += ["".join(draw.choices("a1.@-+ 9(2)%_\x01é", k=draw.randrange(80))) for _ in range(1_000)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(r.doc_id + 10_000, r.text) for r in documents.collect()]
    found = pii.report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    expected = {k: plain_base(t) for k, t in rows}
    assert len(found) == len(rows)
    for r in found:
        base = expected[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s.split(":")[0] in PATTERNS] == base
        assert r.n_spans == len([s for s in r.spans.split(",") if s])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s.startswith(kind) for s in base) for kind in PATTERNS)


def test_secrets_are_added_and_checksums_are_not(spark):
    rows = [(k, f'the token = "{hashlib.sha1(str(k).encode()).hexdigest()}" here') for k in range(40)]
    rows += [(100 + k, f"thewordswithoutanydigits{'abcdefghij'[k % 10] * 9} are text") for k in range(40)]
    found = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(found[k] == "secret:13:53" for k in range(40))
    assert all(found[100 + k] == "" for k in range(40))


def test_expectation_maximisation_finds_reliabilities():
    draw = random.Random(4)
    rates = {"y": [(0.05, 0.8), (0.1, 0.7), (0.4, 0.5)], "n": [(0.7, 0.05), (0.6, 0.1), (0.4, 0.4)]}
    patterns: dict[str, float] = {}
    for _ in range(20_000):
        side = int(draw.random() < 0.3)
        votes = ""
        for k in range(3):
            u = draw.random()
            votes += "y" if u < rates["y"][k][side] else "n" if u < rates["y"][k][side] + rates["n"][k][side] else "-"
        patterns[votes] = patterns.get(votes, 0) + 1
    share, found, chance = pii.reliabilities(patterns, 200)
    assert share == pytest.approx(0.3, abs=0.04)
    assert found[0]["y"][1] == pytest.approx(0.8, abs=0.06) and found[0]["y"][0] == pytest.approx(0.05, abs=0.04)
    assert chance["yyy"] > 0.95 > 0.05 > chance["nnn"]


def test_mask(spark, odd):
    text = "日本 write a@b.cd or +49 30 1234567, card 4111 1111 1111 1111."
    rows = spark.createDataFrame([(1, text, 3), (2, None, None), (3, "nothing", 7)], "doc_id bigint, text string, n_chars bigint")
    found = {r.doc_id: r for r in pii.mask(rows).collect()}
    assert found[1].text == "日本 write [email] or [phone], card [card]." and found[1].n_chars == len(found[1].text)
    assert found[2].text is None and found[2].n_chars is None and found[3].text == "nothing"
    assert pii.mask(odd).columns == odd.columns and pii.mask(odd).count() == 10


def test_odd_rows(odd, none, by_doc):
    rows = by_doc(pii.report(odd))
    assert len(rows) == 10 and {r["spans"] for r in rows} == {""}
    assert pii.report(none).count() == 0


def test_no_python_on_the_executors(documents, plan):
    text = plan(pii.report(documents)) + plan(pii.mask(documents))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 64, 65, 1_000])
def test_many_matches_in_one_text(spark, n):
    """Places and masked text at and around the bounds of blocks, with characters of several bytes."""
    text = "é " + " ü\n".join(f"u{k}@ex{k}.org" for k in range(n)) + " 𝒳 end"
    plainly = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    found = docs.select(pii.matches(pii.clean(F.col("text")), pii.EMAIL, 5).alias("m")).first().m
    assert [(m.begin, m.end, m.value, m.left) for m in found] == [
        (m.start(), m.end(), m[0], text[max(m.start() - 5, max([0, *(e.end() for e in plainly.finditer(text[: m.start()]))])) : m.start()])
        for m in plainly.finditer(text)
    ]
    assert pii.mask(docs).first().text == plainly.sub("[email]", text)


def test_overlapping_spans_are_replaced_once(spark):
    """The span that begins first stays, of those the longest; spans that reach into a later block too."""
    text = "".join(chr(97 + k % 26) for k in range(400))
    spans = [(k, k + 2 if k % 2 else k + 3) for k in range(0, 390, 2)] + [(100, 300), (100, 120), (395, 400)]
    rows = spark.createDataFrame([(text, [(b, -e, "x") for b, e in sorted(spans, key=lambda s: (s[0], -s[1]))])], "text string, o array<struct<begin:int,back:int,kind:string>>")
    want, at = "", 0
    for b, e in sorted(spans, key=lambda s: (s[0], -s[1])):
        if b >= at:
            want, at = want + text[at:b] + "[x]", e
    assert rows.select(pii._replaced(F.col("text"), F.col("o")).alias("x")).first().x == want + text[at:]

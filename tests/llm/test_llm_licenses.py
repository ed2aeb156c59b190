import random
import re

import pytest

from goldseam.llm import licenses


def plain(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base(spark, documents):
    draw = random.Random(5)
    parts = "under the MIT License apache license, version 2 cc by-nc nc é x 2.0 \n".split(" ")
    texts = [r.text for r in documents.collect()] + [" ".join(draw.choices(parts, k=draw.randrange(60))) for _ in range(500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in licenses.scan(rows).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) or not r.base_labels


def as_regex(markup):
    """The template as a regular expression over words that each end in a space."""
    out = ""
    for token in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", markup):
        out += "(?:" if token == "[[" else ")?" if token == "]]" else rf"(?:\S+ ){{0,{token[2:-2]}}}" if token[0] == "{" else token + " "
    return out


@pytest.mark.parametrize("markup", ["a [[b {{2}}]] c", "a {{1}} {{2}} b", "a [[b [[c]] d]] [[e]] f", "a b [[{{3}} c]]", "a [[a]] a b"])
def test_automata_accept_what_regular_expressions_do(markup):
    made, pattern, draw = licenses.compile_template("x", markup), re.compile(as_regex(markup)), random.Random(6)
    for _ in range(3_000):
        words = draw.choices("abcdef", k=draw.randrange(1, 12))
        expected = pattern.match("".join(w + " " for w in words))
        end = made.match([w.encode() for w in words], 0)
        assert (end is not None) == bool(expected), words


@pytest.mark.parametrize("markup", ["[[a]]", "{{3}} a", "[[a"])
def test_templates_without_mandatory_wording_are_refused(markup):
    with pytest.raises(ValueError):
        made = licenses.compile_template("x", markup)
        made.firsts()


def test_labels_of_templates():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.PHRASES)
    text = b"This small work is licensed under the GNU General Public License, version 3."
    assert scanner.scan(text)[5:] == ("gpl-3", 1.0)
    assert scanner.scan(text.replace(b"Public ", b""))[5:] == ("", 0.0)  # mandatory wording must be complete
    assert scanner.scan(b"not under the MIT license")[4:] == ("mit", "mit", 0.5)


def test_odd_rows(odd, none, by_doc):
    rows = by_doc(licenses.scan(odd))
    assert len(rows) == 10 and {r["labels"] for r in rows} == {""} and rows[3] == rows[4] and rows[0]["n_words"] == 0
    assert licenses.scan(none).count() == 0

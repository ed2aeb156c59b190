import math
from collections import Counter

import numpy as np
import pytest

from goldseam.llm import langid

TEXTS = {"a": [b"the cat sat on the mat", b"the hat"], "b": [b"le chat est la", "été le".encode()]}


@pytest.fixture
def model():
    counts = []
    for texts in TEXTS.values():
        q, n = np.unique(np.concatenate([langid.quads(t) for t in texts]), return_counts=True)
        counts.append((q, n.astype(float)))
    return langid.build(sorted(TEXTS), counts)


def plain_cost(texts, text):
    """Prediction by partial matching, method C with exclusion, straight from its definition."""
    contexts = [Counter() for _ in range(4)]
    for t in texts:
        padded = langid.START + t
        for i in range(3, len(padded)):
            for k in range(4):
                contexts[k][padded[i - k : i + 1]] += 1
    padded, bits = langid.START + text, 0.0
    for i in range(3, len(padded)):
        excluded, p = set(), 1.0
        for k in (3, 2, 1, 0):
            before = padded[i - k : i]
            seen = {s[-1]: n for s, n in contexts[k].items() if s[:-1] == before}
            if not seen:
                continue
            total, distinct = sum(seen.values()), len(seen)
            if padded[i] in seen:
                p *= seen[padded[i]] / (total + distinct)
                break
            # what the shorter contexts give to bytes seen here is not needed: spread over the others
            p *= distinct / (total + distinct) / (1 - sum(lower(contexts, padded[i - k : i], s) for s in seen))
        else:
            p *= 1 / 256
        bits -= math.log2(p)
    return bits


def lower(contexts, before, symbol):
    """Probability of a byte in the contexts shorter than ``before``."""
    p = 1.0
    for k in range(len(before) - 1, -1, -1):
        context = before[len(before) - k :]
        seen = {s[-1]: n for s, n in contexts[k].items() if s[:-1] == context}
        if not seen:
            continue
        total, distinct = sum(seen.values()), len(seen)
        if symbol in seen:
            return p * seen[symbol] / (total + distinct)
        p *= distinct / (total + distinct) / (1 - sum(lower(contexts, context, s) for s in seen))
    return p / 256


@pytest.mark.parametrize("text", [b"the cat", b"le chat la", b"zzz \xff", b"that hat", "été".encode()])
def test_code_lengths_follow_the_definition(model, text):
    expected = [plain_cost(TEXTS[lang], text) for lang in model.languages]
    assert langid.code_lengths(text, model) == pytest.approx(expected, rel=1e-9)


@pytest.mark.parametrize("before", [b"the", b"at ", b"qqq", b"\xc3"])
def test_probabilities_sum_to_one(model, before):
    base = langid.code_lengths(before, model)
    total = sum(np.exp2(base - langid.code_lengths(before + bytes([b]), model)) for b in range(256))
    assert total == pytest.approx([1, 1], abs=1e-9)


def test_blocks_change_nothing(model):
    text = b"the cat sat le chat " * 50
    assert langid.code_lengths(text, model, block=7) == pytest.approx(langid.code_lengths(text, model))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(odd, none, by_doc, model, documents):
    rows = by_doc(langid.identify(odd, model))
    assert len(rows) == 10
    assert [r["lang_pred"] == "und" for r in rows][:3] == [True] * 3
    assert rows[3] == rows[4] and rows[3]["lang_pred"] in TEXTS
    assert langid.identify(none).count() == 0
    assert {r["lang_pred"] for r in by_doc(langid.identify(odd))} == {"und"}  # nothing to learn from

import tracemalloc

import numpy as np
import pytest

from goldseam.llm import toxicity


def test_held_out_and_misspellings(spark):
    rng = np.random.default_rng(4)
    harmless = ["".join(rng.choice(list("aeiorstn"), 6)) for _ in range(300)]
    texts, labels = [], []
    for k in range(400):
        words = list(rng.choice(harmless, 30))
        if k % 4 == 0:
            words[int(rng.integers(30))] = str(rng.choice(["worthless", "disgusting", "scumbag"]))
        texts.append(" ".join(words).encode())
        labels.append(k % 4 == 0)
    model = toxicity.fit(texts[:300], np.array(labels[:300], float))
    cache = toxicity._WordLogits(model)
    scores = toxicity.score_texts(texts[300:], model, cache)
    assert ((scores > 0.5) == np.array(labels[300:])).mean() > 0.97
    long = " ".join(rng.choice(harmless, 3_000)).encode()
    clean, bad = toxicity.score_texts([long, long[:9_000] + b" w0rthless " + long[9_000:]], model, cache)
    assert bad > clean and bad > 0.5


def test_scores_are_the_softmax_of_averaged_embeddings():
    rng = np.random.default_rng(5)
    model = toxicity.ToxicityModel(64, 3, 4, 2, rng.normal(size=(64, 3)).astype(np.float32), rng.normal(size=(3, 2)), rng.normal(size=2))
    words = [b"some", b"few", b"words"]
    vectors = [model.embeddings[toxicity.subwords(w, 64, 3, 4)].mean(0) for w in words]
    best = max(np.exp(z)[1] / np.exp(z).sum() for i in (0, 1) for z in [np.mean(vectors[i : i + 2], 0) @ model.softmax + model.bias])
    assert abs(toxicity.score_texts([b"Some few, WORDS"], model, toxicity._WordLogits(model))[0] - best) < 1e-6


def test_document_set(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.judge(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    clean = [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in clean) / len(clean) < 0.05
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.9


def test_odd_rows(odd, none, labels, by_doc):
    rows = by_doc(toxicity.judge(odd, labels))
    assert len(rows) == 10 and rows[3] == rows[4] and rows[0]["score"] == rows[1]["score"] == rows[2]["score"]
    kept = toxicity.reject(odd, labels.where("doc_id < 0"))
    assert kept.columns == odd.columns and kept.count() == 10  # without labels nothing is toxic
    assert toxicity.judge(none, labels).count() == 0


def test_text_without_blanks_is_scored_to_its_end():
    rng = np.random.default_rng(6)
    letters = [chr(c) for c in range(0x4E00, 0x4E60)]
    texts, labels = [], []
    for k in range(240):
        text = "".join(rng.choice(letters, 120))
        if k % 3 == 0:
            at = int(rng.integers(30, 110))
            text = text[:at] + "垃圾废物" + text[at:]
        texts.append(text.encode())
        labels.append(k % 3 == 0)
    model = toxicity.fit(texts[:180], np.array(labels[:180], float))
    scores = toxicity.score_texts(texts[180:], model, toxicity._WordLogits(model))
    assert ((scores > 0.5) == np.array(labels[180:])).mean() > 0.9


def test_every_gram_of_a_long_word_is_in_a_piece():
    for n in (1, 64, 65, 112, 113, 500):
        word = bytes(range(97, 123)) * 20
        word = word[:n]
        made = toxicity.pieces(word)
        assert max(map(len, made)) <= toxicity.PIECE
        assert {word[i : i + 7] for i in range(max(n - 6, 1))} <= {p[i : i + 7] for p in made for i in range(len(p))}


def test_separators_beyond_ascii():
    assert toxicity.words_of("You\u00a0are\u2014bad\uff01caf\u00e9 \u0e17\u0e35\u0e48".encode()) == [b"you", b"are", b"bad", "caf\u00e9".encode(), "\u0e17\u0e35\u0e48".encode()]


def _random_texts(count, words):
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    return [" ".join("".join(w) for w in rng.choice(letters, (words, 10))).encode() for _ in range(count)]


def test_fit_holds_words_and_grams_and_little_else(monkeypatch):
    monkeypatch.setattr(toxicity, "SLICE", 1 << 12, raising=False)
    texts, labels = _random_texts(100, 200), np.arange(100) % 4 == 0
    grams = sum(len(toxicity.subwords(w, 64, 3, 7)) for t in texts for w in set(t.split()))
    tracemalloc.start()
    toxicity.fit(texts, labels, buckets=1 << 10, epochs=4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 14 * grams  # 4 for each n-gram, and the words; copies of all n-grams as 8 bytes each were 24 more


@pytest.mark.parametrize("texts", [_random_texts(40, 12) + [b"", b"one", b"\t"], [b"", b" ", b"."]])
def test_slices_do_not_change_the_fit(monkeypatch, texts):
    labels = np.arange(len(texts)) % 3 == 0
    whole = toxicity.fit(texts, labels, buckets=1 << 10, epochs=8)
    monkeypatch.setattr(toxicity, "SLICE", 50)
    cut = toxicity.fit(iter(texts), labels, buckets=1 << 10, epochs=8)
    assert (whole.embeddings == cut.embeddings).all() and np.allclose(whole.softmax, cut.softmax) and np.allclose(whole.bias, cut.bias)

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from goldseam.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def coders():
    return bpe.coders(open(PATH, encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_random_texts(coders, library):
    encoder, decoder = coders
    draw = random.Random(1)
    letters = "aabbcctthhee's ABÇé́ ŒßİΣσς\n\t\x1c\x85 123<|endoftext|>日本😀👍🏽՘\U0003fffd"
    texts = ["".join(draw.choices(letters, k=draw.randrange(60))) for _ in range(4_000)]
    texts += ["", "x<|endoftext|>y<|startoftext|>", "ab" * 5_000 + "th" * 3_000, "".join(draw.choices("aeinorst", k=9_000))]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == ids, repr(text)
        assert decoder.decode(ids).decode() == library.decode(ids, skip_special_tokens=False)


def test_every_token_and_pair(coders, library):
    encoder, _ = coders
    draw = random.Random(2)
    words = draw.sample(sorted(encoder.ids), 3_000)
    for a, b in zip(words, words[1:]):
        a = a.removesuffix(bpe.END)
        text = "".join(chr(c) for c in bytes({v: k for k, v in encoder.letters.items()}[x] for x in (a + b).removesuffix(bpe.END)).decode("utf-8", "ignore").encode("utf-8") if c < 128)
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_documents(documents, library):
    rows = {r.doc_id: r for r in bpe.round_trip(documents, PATH).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        joined = " ".join(map(str, ids)).encode()
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256) == (len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(decoded).hexdigest())


def test_encode_then_decode(odd, none, by_doc, library):
    encoded = bpe.encode(odd, PATH)
    rows = by_doc(encoded)
    assert len(rows) == 10 and rows[0]["ids"] == rows[1]["ids"] == rows[2]["ids"] == [] and rows[3] == rows[4]
    texts = by_doc(bpe.decode(encoded, PATH))
    assert [r["text"] for r in texts] == [library.decode(r["ids"], skip_special_tokens=False) for r in rows]
    assert bpe.decode(encoded.selectExpr("doc_id", "cast(null as array<int>) as ids"), PATH).first().text == ""
    assert bpe.round_trip(none, PATH).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())


def test_encoders_do_not_outlive_their_tasks(spark, documents):
    def held(batches):
        import gc

        for batch in batches:
            count = sum(type(x).__name__ == "Encoder" and type(x).__module__ == bpe.__name__ for x in gc.get_objects())
            yield pa.RecordBatch.from_pydict({"held": pa.array([count] * batch.num_rows, pa.int32())})

    rows = documents.select("doc_id", "text").repartition(4)
    assert rows.mapInArrow(held, "held int").agg({"held": "max"}).first()[0] == 0
    bpe.tokens(rows, PATH).agg({"n_tokens": "sum"}).collect()
    assert rows.mapInArrow(held, "held int").agg({"held": "max"}).first()[0] == 0

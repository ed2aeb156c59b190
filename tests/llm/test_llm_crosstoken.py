"""Token alignment against a walk over both token lists; cuts and stitches; odd rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from goldseam.llm.bound import ALIGNED
from goldseam.llm.crosstoken import align, contents, cuts, overlaps, pair, statistics

FILES = tuple(map(public_tokenizers.path, ALIGNED))


def walk(a, b):
    """Links and closing links of two lists of ends, one step at a time."""
    i = j = 0
    made = []
    while i < len(a) and j < len(b):
        made.append((i, j, a[i] == b[j]))
        step = min(a[i], b[j])
        i, j = i + (a[i] == step), j + (b[j] == step)
    return made


def byte_table():
    """Byte-level characters, by their rule: printable bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def plain(texts):
    """The result by definition, from the tokenizers library."""
    import sentencepiece

    a_lib = Tokenizer.from_file(FILES[1])
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=FILES[2])
    table = byte_table()
    docs, counts = [], Counter()
    for text in texts:
        a = b = []
        if text:
            a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
            a_bytes = [bytes(table[c] for c in a_lib.id_to_token(k)) for k in a]
            b_bytes = [bytes([int(b_lib.id_to_piece(k)[3:5], 16)]) if b_lib.is_byte(k) else b_lib.id_to_piece(k).replace("▁", " ").encode() for k in b]
            if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                a = b = []
        links = walk(np.cumsum([len(t) for t in a_bytes]), np.cumsum([len(t) for t in b_bytes])) if a else []
        counts.update((a[i], b[j]) for i, j, _ in links)
        docs.append((a, b, links))
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for a, b, links in docs:
        groups, seen = [], (0, 0)
        for i, j, closes in links:
            if closes:
                groups.append(",".join(map(str, a[seen[0] : i + 1])) + "|" + ",".join(map(str, b[seen[1] : j + 1])))
                seen = (i + 1, j + 1)
        found = [counts[a[i], b[j]] for i, j, _ in links]
        best = sum(n == top[b[j]] for n, (_, j, _) in zip(found, links))
        out.append((len(a), len(b), len(groups), len(links), best, sum(found), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    return out


ODD = [
    None, "", " ", "  a  b ", "<|endoftext|> <s> </s> <0x41> <unk>", "▁ under▁lined", "日本語 😀 é é", "\x00\x01\t\r\n", "ﬁ\xa0x", "a" * 5_000, " " * 3_000, "the same", "the same",
    "x퟿￿", "don't  they'll",
]


def rows(df):
    return [tuple(r)[1:] for r in sorted(df.collect(), key=lambda r: r.doc_id)]


@pytest.mark.parametrize("sizes", [(2 << 20, 12 << 20), (2_000, 5_000), (1, 1)])
def test_statistics_by_definition(spark, documents, sizes):
    texts = ODD + [r.text for r in documents.limit(40).collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    assert rows(statistics(df, FILES, *sizes)) == plain(texts)


def test_groups(spark):
    made = align(spark.createDataFrame([(k, t) for k, t in enumerate(ODD)], "doc_id int, text string"), FILES, 100).collect()
    for r in made:
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")
        assert r.n_groups == (r.groups.count(";") + 1 if r.groups else 0)


def test_every_cut_gives_the_same_overlaps():
    made = random.Random(1)
    for _ in range(60):
        end = made.randint(1, 60)
        a, b = (np.array(sorted({*made.sample(range(1, end + 1), made.randint(0, end)), end}), np.int64) for _ in range(2))
        want = walk(a, b)
        for work in (1, 2, 3, 7, 1000):
            i, j = cuts(a, b, work)
            assert (np.diff(i + j)[:-1] == work).all() and i[-1] == len(a) and j[-1] == len(b)
            assert [(x, y, z) for x, y, z in zip(*overlaps(a, b, work))] == want
    none = np.zeros(0, np.int64)
    assert all(len(x) == 0 for x in overlaps(none, none))


def test_vocabularies_are_the_same():
    p, lib, table = pair(*contents(FILES)), Tokenizer.from_file(FILES[1]), byte_table()
    for k, token in enumerate(p.a_bytes):
        assert bytes(table[c] for c in lib.id_to_token(k)) == token
    for text in ODD[2:]:
        assert list(p.encode_a(text)) == p._slow.encode(text, add_special_tokens=False).ids


def test_odd_tables(spark, odd, none):
    made = statistics(odd, FILES).collect()
    assert len(made) == odd.count() and {r.n_a for r in made if r.doc_id in (1, 2)} == {0}
    assert [r.count_sum for r in made if r.doc_id == 4] == [3, 3]  # one link in each of three rows
    assert statistics(none, FILES).collect() == []

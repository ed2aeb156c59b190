"""Byte-pair encoding by backtracking, and decoding by an offset table.

Merging pairs by rank gives one token sequence per word: the only one in which no two
neighbours, merged by rank, would have become other tokens. So the encoder walks over a word's bytes
and takes the longest token that starts there, from an Aho-Corasick automaton, if it is compatible with the
token before; else the next longest prefix that is a token; with none left it takes back the token before. A
bit per position marks what has been shown to lead nowhere, so that every position is tried once.

Whether two tokens may stand side by side is looked up in a table of pairs, filled on first sight: both
are taken apart along the merges that made them, and they are incompatible if some pair of
parts that meet in the middle has a merge ranked before those that made the parts.

Texts are prepared as the vocabulary file says: composed (NFC), white space to one space, lower-cased,
special tokens cut out first, then split into words; a word's last token carries an end mark.
Null texts count as empty: no tokens. Repeated rows encode alike; a null doc_id is kept. The
vocabulary is a file on every machine, or its content; it is never copied.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from goldseam.llm.common import trimmed

END = "\n"  # no byte letter
LONG = 64  # longer words and chunks are not remembered
CONTROLS = re.compile("[\x1c-\x1f]")
BLANKS = regex.compile(r"[\t-\r\x85\p{Z}]+")


class _Remembered(dict):
    """A function's values by argument; emptied when full. Arguments past LONG characters are not kept."""

    def __init__(self, function, limit: int):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, key):
        value = self.function(key)
        if len(key) <= LONG:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class Vocabulary:
    """Tokens, ranked merges and word rules of a vocabulary file with an end-of-word mark."""

    def __init__(self, content: str):
        data = json.loads(content)
        model = data["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("a byte-level BPE vocabulary with an end-of-word mark is needed")
        if data.get("decoder") is not None or data.get("post_processor") is not None:
            raise ValueError("decoders and post-processors are not supported")
        self._check_rules(data)
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        tokens = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        tokens |= {i: t for t, i in self.special.items()}
        self.tokens = [tokens[i] for i in range(max(tokens) + 1)]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> rank, result
        self.parts: dict[int, tuple[int, int]] = {}  # result -> the pair it is made of
        for rank, (a, b) in enumerate(pairs):
            pair, made = (self.ids[a], self.ids[b]), self.ids[a + b]
            self.merges.setdefault(pair, (rank, made))
            if made in self.parts:
                raise ValueError("a token made by two merges has no single way to be taken apart")
            self.parts[made] = pair
        self.rank = {made: self.merges[pair][0] for made, pair in self.parts.items()}

    def _check_rules(self, data: dict) -> None:
        steps = [(n["type"], n.get("pattern", {}).get("Regex"), n.get("content")) for n in data["normalizer"]["normalizers"]]
        if steps != [("NFC", None, None), ("Replace", r"\s+", " "), ("Lowercase", None, None)]:
            raise ValueError("other text preparation than composing, joining blanks and lower-casing")
        split, level = data["pre_tokenizer"]["pretokenizers"]
        if (split["behavior"], split["invert"]) != ("Removed", True) or level["type"] != "ByteLevel" or level["use_regex"] or level["add_prefix_space"]:
            raise ValueError("other word rules than one pattern")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.rules = Tokenizer.from_str(json.dumps(data))
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in data["added_tokens"]):
            raise ValueError("special tokens that take in their surroundings")


class Encoder:
    """Encodes texts; ``limit`` bounds the chunks and the pairs remembered."""

    BLOCK = 4096

    def __init__(self, vocabulary: Vocabulary, limit: int = 400_000):
        self.v, self.limit = vocabulary, limit
        self.letters = byte_letters()
        self.compatible: dict[tuple[int, int], bool] = {}
        self.chunks = _Remembered(self._encode_chunk, limit)
        self.words = _Remembered(self._encode_plain, limit)
        self.assigned: set[str] = set()
        self.special = re.compile("|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True))) or r"(?!)")
        self.ids = {self._key(text): i for text, i in vocabulary.ids.items() if self._makes_itself(i)}
        self.sizes = {i: len(key) for key, i in self.ids.items()}
        self.longest = max(self.sizes.values())
        # The next longest token that begins the same way, -1 for none: what to try after a token.
        self.shorter = {i: next((self.ids[key[:n]] for n in range(len(key) - 1, 0, -1) if key[:n] in self.ids), -1) for key, i in self.ids.items()}
        self.names = [str(i) for i in range(len(vocabulary.tokens))]
        self.automaton = ahocorasick.Automaton()
        for key, i in self.ids.items():
            self.automaton.add_word(key, (i, len(key) - 1))
        self.automaton.make_automaton()

    def _key(self, token: str) -> str:
        """The token with its end mark as one character, so that it can only match where a word ends."""
        end = self.v.end
        return token.removesuffix(end) + END if end and token != end and token.endswith(end) else token

    def _makes_itself(self, token: int) -> bool:
        """Whether merging by rank can end in this token: the parts it is made of must be able to meet until its own merge."""
        if token not in self.v.parts:
            return True
        left, right = self.v.parts[token]
        return self._meet(left, right, self.v.rank[token])

    def may_meet(self, left: int, right: int) -> bool:
        """The table of pairs: whether merging by rank leaves these two tokens side by side."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) >= self.limit:
                self.compatible.clear()
            known = self.compatible[left, right] = self._meet(left, right, len(self.v.merges))
        return known

    def _meet(self, left: int, right: int, limit: int) -> bool:
        """Whether no merge across the seam comes in before rank ``limit``.

        Goes back in time: of the two tokens at the seam, the one made last is taken apart, and the
        part at the seam was there only until that merge. A merge across the seam that ranks
        lower would have taken it first. Of two equal merges the left one is done first.
        """
        merges, parts, rank = self.v.merges, self.v.parts, self.v.rank
        while True:
            across = merges.get((left, right))
            if across is not None and across[0] < limit:
                return False
            made_left, made_right = rank.get(left, -1), rank.get(right, -1)
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                limit, left = min(limit, made_left), parts[left][1]
            else:
                limit, right = min(limit, made_right + 1), parts[right][0]

    def _longest(self, word: str, block: int) -> list[int]:
        """For every position of a block, the longest token that starts there, -1 for none."""
        begin = block * self.BLOCK
        size = min(self.BLOCK, len(word) - begin)
        found = [-1] * (size + self.longest)
        for last, (i, back) in self.automaton.iter(word, begin, min(len(word), begin + self.BLOCK + self.longest)):
            found[last - back - begin] = i  # matches from one place come with growing ends
        return found[:size]

    def encode_word(self, word: str) -> list[int]:
        """Token ids of a word in byte letters that ends in END, by backtracking."""
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        sizes, shorter, known, length = self.sizes, self.shorter, self.compatible, len(word)
        out: list[int] = []
        dead = bytearray(length + 1)  # positions from which the rest cannot be encoded
        block, found = 0, self._longest(word, 0)
        at, token = 0, found[0]
        while at < length:
            while token >= 0:
                end = at + sizes[token]
                if not dead[end]:
                    if not out:
                        break
                    fits = known.get((out[-1], token))
                    if fits or fits is None and self.may_meet(out[-1], token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                if at < length:
                    if at // self.BLOCK != block:
                        block = at // self.BLOCK
                        found = self._longest(word, block)
                    token = found[at - block * self.BLOCK]
            else:
                if not out:
                    raise ValueError("the vocabulary cannot spell a word")
                dead[at] = 1
                last = out.pop()
                at -= sizes[last]
                if at // self.BLOCK != block:
                    block = at // self.BLOCK
                    found = self._longest(word, block)
                token = shorter[last]
        return out

    def _encode_plain(self, word: str) -> tuple[int, ...]:
        return tuple(self.encode_word(word.encode().decode("latin-1").translate(self.letters) + (END if self.v.end else "")))

    def _encode_chunk(self, chunk: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.words.__getitem__, self.v.pattern.findall(chunk))))

    def _unassigned(self, text: str) -> bool:
        """Whether the text has a character that this Python's Unicode tables do not know."""
        new = set(text) - self.assigned
        free = {c for c in new if unicodedata.category(c) == "Cn"}
        self.assigned |= new - free
        return bool(free)

    def _encode_unassigned(self, text: str) -> list[int]:
        """Of a text with unassigned characters: cut by the tokenizer library, whose tables may be newer."""
        words = self.v.rules.pre_tokenizer.pre_tokenize_str(self.v.rules.normalizer.normalize_str(text))
        return [i for word, _ in words for i in self.encode_word(word + (END if self.v.end else ""))]

    def encode(self, text: str) -> list[int]:
        """Token ids of a whole text."""
        ids: list[int] = []
        begin = 0
        unassigned = not text.isascii() and self._unassigned(text)
        for special in (*self.special.finditer(text), None):
            part = text[begin : special.start()] if special else text[begin:]
            if unassigned:
                ids += self._encode_unassigned(part)
            else:
                ids += chain.from_iterable(map(self.chunks.__getitem__, chunks_of(part)))
            if special:
                ids.append(self.v.special[special.group()])
                begin = special.end()
        return ids


def chunks_of(text: str) -> list[str]:
    """The text composed, every character lower-cased for itself, and cut at blanks, which no word can hold."""
    if not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # lower() has one rule that looks at neighbours, for the Greek capital sigma.
        text = text.replace("\u03a3", "\u03c3")
    # split() also cuts at four control characters, which are not blanks to the vocabulary's rules.
    return BLANKS.split(text.lower()) if CONTROLS.search(text) else text.lower().split()


class Decoder:
    """Tokens side by side in one buffer, each followed by a space, and where each begins."""

    def __init__(self, vocabulary: Vocabulary):
        parts = [t.encode() + b" " for t in vocabulary.tokens]
        self.buffer = np.frombuffer(b"".join(parts), np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def decode(self, ids: list[int], block: int = 1 << 18) -> bytes:
        """The tokens joined by spaces, in UTF-8, without the last space; looked up for a block of tokens at once."""
        out = []
        for begin in range(0, len(ids), block):
            mine = np.array(ids[begin : begin + block], dtype=np.int64)
            starts = self.offsets[mine]
            sizes = self.offsets[mine + 1] - starts
            ends = np.cumsum(sizes)
            out.append(self.buffer[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])].tobytes())
        return b"".join(out)[:-1]


def coders(content: str) -> tuple[Encoder, Decoder]:
    """Encoder and decoder of a vocabulary."""
    vocabulary = Vocabulary(content)
    return Encoder(vocabulary), Decoder(vocabulary)


def _mapped(docs: DataFrame, column: str, path: str, schema: str, convert) -> DataFrame:
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    names = [part.split()[0] for part in schema.split(", ")]

    def mapped(batches):
        encoder, decoder = coders(shared.value)
        try:
            for batch in batches:
                for begin in range(0, batch.num_rows, 500):
                    part = batch.slice(begin, 500)
                    found = [convert(encoder, decoder, value) for value in part[column].to_pylist()]
                    yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], **{n: [f[k] for f in found] for k, n in enumerate(names)}}, arrow)
        finally:  # Python workers go on to other stages, which need the memory that encoders fill
            del encoder, decoder
            gc.collect()  # an encoder refers to itself

    full = StructType.fromDDL(f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {schema}")
    arrow = to_arrow_schema(full)
    return docs.select("doc_id", column).mapInArrow(trimmed(mapped), full)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids of every whole text; ``path`` names the vocabulary file on the driver."""
    return _mapped(docs, "text", path, "ids array<int>", lambda e, d, text: (e.encode(text or ""),))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of every list of ids; null lists decode as empty ones."""
    return _mapped(encoded, "ids", path, "text string", lambda e, d, ids: (d.decode(ids or []).decode(),))


def _digests(encoder: Encoder, decoder: Decoder, text: str | None) -> tuple[int, str, str]:
    ids = encoder.encode(text or "")
    joined = " ".join(map(encoder.names.__getitem__, ids)).encode()
    return len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(decoder.decode(ids)).hexdigest()


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoding and decoding in one pass, without the ids leaving the task."""
    return _mapped(docs, "text", path, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", _digests)


def _tokens(encoder: Encoder, decoder: Decoder, text: str | None) -> tuple[list[int], int, str]:
    ids = encoder.encode(text or "")
    return ids, len(ids), hashlib.sha256(decoder.decode(ids)).hexdigest()


def tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, n_tokens and the digest of what the ids decode to, for training and its checks."""
    return _mapped(docs, "text", path, "ids array<int>, n_tokens bigint, decoded_sha256 string", _tokens)

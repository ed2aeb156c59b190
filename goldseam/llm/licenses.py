"""License scans by template markup.

A template is a license text with marked regions: optional wording, and replaceable wording of a
bounded number of words. It is compiled into an automaton over words: a state per place in the
template, a step per mandatory word, a silent step past optional regions, and a loop in replaceable
ones. A document carries the license where the automaton accepts a run of its words, so every
mandatory word has to be there, in order, with nothing between but what the template allows.

Beside that, plain phrases are looked for; a phrase found adds its label even without a template.

Null texts count as empty: no words, no labels (empty text), score 0. Repeated rows are scanned
alike; a null doc_id is kept.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: ASCII letters in lower case, digits and all non-ASCII bytes make words.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

#: Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Wording of licenses. [[...]] is optional, {{n}} stands for up to n words of anyone's choice.
TEMPLATES = [
    ("mit", "[[this {{4}} is]] released under the mit license"),
    ("mit", "[[this {{4}} is]] licensed under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
        "and this permission notice [[including the next paragraph]] shall be included in all copies or substantial "
        "portions of the software [[the software is provided as is without warranty of any kind {{80}}]]",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "bsd-2-clause",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met [[1]] redistributions of source code must retain the above copyright notice this "
        "list of conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the above "
        "copyright notice this list of conditions and the following disclaimer in the documentation and or other materials "
        "provided with the distribution",
    ),
    ("bsd-3-clause", "neither the name of {{12}} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("apache-2", "[[this {{4}} is]] licensed under the apache license version 2 [[0]] [[the license]]"),
    ("gpl-2", "[[this {{4}} is]] licensed under the gnu general public license [[as published by the free software foundation]] [[either]] version 2"),
    ("gpl-3", "[[this {{4}} is]] licensed under the gnu general public license [[as published by the free software foundation]] [[either]] version 3"),
    ("lgpl-3", "licensed under the gnu lesser general public license [[as published by the free software foundation]] [[either]] version 3"),
    ("agpl-3", "licensed under the gnu affero general public license [[as published by the free software foundation]] [[either]] version 3"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "[[this {{4}} is]] licensed under [[a]] [[the]] [[creative commons]] cc by nc [[4 0]]"),
    ("cc-by-nc", "licensed under [[a]] [[the]] creative commons attribution noncommercial {{2}} international"),
    ("cc-by-sa", "licensed under [[a]] [[the]] creative commons attribution sharealike {{2}} international"),
    ("cc-by", "licensed under [[a]] [[the]] creative commons attribution 4 0 international"),
    ("cc-by", "licensed under cc by 4 0"),
]


@dataclass
class Automaton:
    """Places 0..last of a template; a word at place s leads to s + 1."""

    label: str
    words: list[bytes | None] = field(default_factory=list)  # what leads on from a place; None: nothing does
    skips: dict[int, list[int]] = field(default_factory=lambda: defaultdict(list))  # silent steps
    free: dict[int, int] = field(default_factory=dict)  # at such a place up to so many words may pass

    def closure(self, active: dict[int, int]) -> dict[int, int]:
        """All places reachable silently; a value counts the free words passed at that place, the least wins."""
        todo = list(active.items())
        found: dict[int, int] = {}
        while todo:
            place, passed = todo.pop()
            if place in found and found[place] <= passed:
                continue
            found[place] = passed
            todo += [(to, 0) for to in self.skips.get(place, ())]
        return found

    def firsts(self) -> set[bytes]:
        """Words that a match can begin with."""
        places = self.closure({0: 0})
        if any(p in self.free for p in places):
            raise ValueError(f"template of {self.label} may begin with any word")
        return {self.words[p] for p in places if p < len(self.words) and self.words[p] is not None}

    def match(self, words: list[bytes], start: int) -> int | None:
        """End of the longest run from ``start`` that the automaton accepts."""
        last, best = len(self.words), None
        active = self.closure({0: 0})
        for at in range(start, len(words) + 1):
            if last in active:
                best = at
            if not active or at == len(words):
                break
            word = words[at]
            moved: dict[int, int] = {}
            for place, passed in active.items():
                if place < last and self.words[place] == word:
                    moved[place + 1] = 0
                if passed < self.free.get(place, 0):
                    moved[place] = min(passed + 1, moved.get(place, passed + 1))
            active = self.closure(moved)
        return best


def compile_template(label: str, markup: str) -> Automaton:
    """Tokens are words, ``[[`` and ``]]`` around optional regions, which may nest, and ``{{n}}``."""
    made = Automaton(label)
    opened: list[int] = []
    for token in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", markup):
        here = len(made.words)
        if token == "[[":
            opened.append(here)
        elif token == "]]":
            made.skips[opened.pop()].append(here)
        elif token.startswith("{{"):
            # A free place of its own, left silently, so that loops do not run into the place before.
            made.words += [None, None]
            made.skips[here].append(here + 1)
            made.free[here + 1] = int(token[2:-2])
            made.skips[here + 1].append(here + 2)
        else:
            made.words.append(token.encode().translate(WORD_BYTES).strip())
    if opened:
        raise ValueError(f"template of {label} has an optional region without an end")
    if len(made.closure({0: 0})) and len(made.words) in made.closure({0: 0}):
        raise ValueError(f"template of {label} has no mandatory wording")
    return made


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        self.phrases = [(phrase.encode().split(), label) for phrase, label in phrases.items()]
        self.starts: dict[bytes, list[Automaton]] = defaultdict(list)
        for label, markup in templates:
            automaton = compile_template(label, markup)
            for word in automaton.firsts():
                self.starts[word].append(automaton)
        self.triggers = sorted({*self.starts, *(words[0] for words, _ in self.phrases)})

    def scan(self, text: bytes | None) -> tuple[int, int, int | None, int | None, str, str, float]:
        """n_words, n_base, first_word, last_word, base_labels, labels, score of a text."""
        plain = (text or b"").translate(WORD_BYTES)
        words = plain.split()
        if not any(t in plain for t in self.triggers):
            return len(words), 0, None, None, "", "", 0.0
        places, base, accepted = [], set(), set()
        for phrase, label in self.phrases:
            if phrase[0] not in plain:
                continue
            at = -1
            for _ in range(words.count(phrase[0])):
                at = words.index(phrase[0], at + 1)
                if words[at : at + len(phrase)] == phrase:
                    places.append(at)
                    base.add(label)
        for word, automata in self.starts.items():
            if word not in plain:
                continue
            at = -1
            for _ in range(words.count(word)):
                at = words.index(word, at + 1)
                accepted.update(a.label for a in automata if a.label not in accepted and a.match(words, at) is not None)
        labels = ",".join(sorted(base | accepted))
        score = 1.0 if accepted else 0.5 if base else 0.0
        return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), labels, score


SCHEMA = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
)


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every whole text.

    ``score`` is 1 if a template accepts some wording, 0.5 if only a phrase is there, else 0.
    """
    given = (TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases)

    def scanned(batches):
        scanner = Scanner(*given)
        for batch in batches:
            rows = [scanner.scan(text) for text in batch["text"].to_pylist()]
            columns = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_ARROW)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", *_ARROW.names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(scanned, f"doc_id {kind}, {SCHEMA}")

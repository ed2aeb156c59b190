"""Statistics of whole texts that the quality operators share, computed on UTF-8 bytes."""

from __future__ import annotations

from collections import Counter
from itertools import pairwise

import numpy as np

BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

_CLASS = np.zeros(256, dtype=np.uint8)  # 0 other ASCII punctuation, then the classes below
_CLASS[list(BLANKS)] = 1
_CLASS[list(SYMBOLS)] = 2
_CLASS[48:58] = 3
_CLASS[65:91] = 4
_CLASS[97:123] = 5
_CLASS[128:192] = 6  # continuation bytes
_CLASS[192:] = 7  # first bytes of longer characters
_CLASS[33] = 8  # exclamation mark
OTHER, BLANK, SYMBOL, DIGIT, UPPER, LOWER, CONTINUED, LONGER, SHOUT = range(9)


def class_counts(text: bytes) -> np.ndarray:
    """Number of bytes of each class."""
    return np.bincount(_CLASS[np.frombuffer(text, dtype=np.uint8)], minlength=9)


def repeat_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that the text holds twice or more, its first place included."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    marked, end = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            marked += i + 3 - max(end, i)
            end = i + 3
    return marked


def line_counts(text: bytes) -> tuple[int, int]:
    """Lines that have a word, and how many of them equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(BLANKS)]
    return len(lines), len(lines) - len(set(lines))


def base_statistics(text: bytes | None) -> dict[str, float]:
    """Word and line statistics; words are what blanks separate."""
    text = text or b""
    words = text.split()  # bytes split at exactly the ASCII blanks
    classes = class_counts(text)
    lines, duplicates = line_counts(text)
    return {
        "n_words": len(words),
        "word_chars": int(len(text) - classes[CONTINUED] - classes[BLANK]),
        "n_symbols": int(classes[SYMBOL]),
        "n_dup_lines": duplicates,
        "n_repeat_words": repeat_words(words),
        "n_lines": lines,
        "n_distinct": len(set(words)),
        "classes": classes,
        "same_pairs": sum(a == b for a, b in pairwise(words)),
    }


SHARES = (
    "word_length", "symbols", "digits", "upper", "shouts", "punctuation", "dup_lines", "repeats", "variety", "line_words",
    "doubled",
)


def shares(s: dict[str, float]) -> list[float]:
    """The statistics of SHARES: sizes as logarithms, parts as square roots, so that both spread evenly.

    A text without words has all zeros.
    """
    n = s["n_words"]
    if not n:
        return [0.0] * len(SHARES)
    c = s["classes"]
    chars = max(1, s["word_chars"])
    letters = max(1, int(c[UPPER] + c[LOWER] + c[LONGER]))
    return [
        float(np.log(chars / n)),
        float(np.sqrt(s["n_symbols"] / chars)),
        float(np.sqrt(c[DIGIT] / chars)),
        float(np.sqrt(c[UPPER] / letters)),
        float(np.sqrt(c[SHOUT] / n)),
        float(np.sqrt(c[OTHER] / chars)),
        float(np.sqrt(s["n_dup_lines"] / max(1, s["n_lines"]))),
        float(np.sqrt(s["n_repeat_words"] / n)),
        float(np.log(s["n_distinct"]) / np.log(n)) if n > 1 else 1.0,
        float(np.log(n / max(1, s["n_lines"]))),
        float(np.sqrt(s["same_pairs"] / n)),
    ]

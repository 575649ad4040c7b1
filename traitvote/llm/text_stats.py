"""Counts over whole texts, for use in tasks."""

from __future__ import annotations

import string
from collections import Counter

import numpy as np
import xxhash

WHITE_SPACE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
CACHE_WORDS = 500_000


class Words:
    """Words between ASCII white space as numbers; remembers hashes of words."""

    def __init__(self) -> None:
        self._cache: dict[bytes, int] = {}

    def split(self, text: str) -> list[bytes]:
        return text.encode("utf-8", "surrogatepass").split()

    def hashes(self, words: list[bytes]) -> np.ndarray:
        cache = self._cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for word in words:
            if word not in cache:
                cache[word] = xxhash.xxh64_intdigest(word)
        return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def covered_by_repeats(hashes: np.ndarray, window: int = 3) -> int:
    """Words in windows of ``window`` words that occur twice or more."""
    if len(hashes) <= window:
        return 0
    ids = np.unique(hashes, return_inverse=True)[1].astype(np.int64)
    starts = len(ids) - window + 1
    keys = np.zeros(starts, np.int64)
    for k in range(window):  # numbered anew after each word, so numbers stay small
        keys = np.unique(keys * len(ids) + ids[k : starts + k], return_inverse=True)[1]
    repeated = np.bincount(keys)[keys] >= 2
    covered = np.zeros(len(ids), bool)
    for k in range(window):
        covered[k : starts + k] |= repeated
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(WHITE_SPACE)]
    return len(lines) - len(set(lines))


def word_chars(text: str) -> int:
    return len(text) - sum(text.count(c) for c in WHITE_SPACE)


def count_of(text: str, characters: str) -> int:
    return sum(text.count(c) for c in characters)


#: What :func:`stats` measures, in order.
STATS = (
    "log_words", "word_length", "longest_word", "symbols", "upper", "digits", "marks", "bars",
    "other_scripts", "distinct_words", "top_word", "same_as_previous", "repeated_runs",
    "repeated_lines", "words_per_line", "sentence_ends", "log_sentence", "doubled_marks",
)


def stats(text: str, words: Words) -> list[float]:
    """Shares and lengths of a text; all zero where it has no word."""
    split = words.split(text)
    n = len(split)
    if n == 0:
        return [0.0] * len(STATS)
    hashes = words.hashes(split)
    chars = max(1, word_chars(text))
    counts = Counter(split)
    lines = [line for line in text.split("\n") if line.strip(WHITE_SPACE)]
    letters = max(1, sum(map(str.isalpha, text)))
    ends = text.count(".") + text.count("!") + text.count("?")
    return [
        float(np.log1p(n)),
        chars / n,
        float(max(map(len, split))),
        count_of(text, SYMBOLS) / chars,
        sum(map(str.isupper, text)) / letters,
        count_of(text, string.digits) / chars,
        count_of(text, ".,;:!?") / chars,
        text.count("|") / chars,
        1 - len(text.encode("ascii", "ignore")) / len(text),
        len(counts) / n,
        max(counts.values()) / n,
        float(np.count_nonzero(hashes[1:] == hashes[:-1])) / n,
        covered_by_repeats(hashes) / n,
        (len(lines) - len(set(lines))) / len(lines),
        float(np.log1p(n / len(lines))),
        ends / n,
        float(np.log1p(n / (ends + 1))),
        (text.count("!!") + text.count("..") + text.count("&&") + text.count("**")) / n,
    ]

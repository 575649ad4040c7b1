"""License scans by an exact set-similarity join of text blocks and templates.

A block is a run of as many words as a template has, at every place of a text.
It meets a template if it contains enough of the template's distinct words.
Words are ordered by their frequency over all documents. By the prefix filter a
block that meets a template contains one of its rarest words; an inverted index
leads from these to their templates, so a text is held against those templates
alone, and only around such words. By the length filter a block has enough words
that any template knows; by the positional filter enough words of the template
come after the prefix word in the global order. Blocks that pass are compared in
full.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    """``percent`` of the distinct words of ``text`` have to be in a block.

    ``phrase`` asks for the words in their order and nothing between them.
    """

    label: str
    text: str
    percent: int = 100
    phrase: bool = False


# --- Fixed values: phrases and notices by which licenses are known. ---
BASE = (
    Template("mit", "mit license", phrase=True),
    Template("apache", "apache license", phrase=True),
    Template("gpl", "general public license", phrase=True),
)
NOTICES = (
    Template("cc", "licensed under cc by"),
    Template("proprietary", "all rights reserved", phrase=True),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
        80,
    ),
    Template(
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy "
        "of the license at",
        80,
    ),
    Template(
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation",
        80,
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        80,
    ),
)

_APART = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and other scripts, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_APART).split()


@dataclass(frozen=True)
class Prepared:
    """A template whose distinct words are numbered in the global order."""

    template: Template
    words: tuple[bytes, ...]
    tokens: np.ndarray
    need: int

    @property
    def width(self) -> int:
        return len(self.words)


class Scanner:
    """Finds the blocks of a text that meet one of some templates."""

    def __init__(self, templates: tuple[Template, ...], frequency: dict[bytes, int]) -> None:
        split = [tuple(words_of(t.text)) for t in templates]
        order = sorted({w for ws in split for w in ws}, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {word: k for k, word in enumerate(order)}
        self.templates = []
        #: By prefix word: the templates it leads to and its place in their order.
        self.index: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for template, words in zip(templates, split, strict=True):
            tokens = np.array(sorted({self.rank[w] for w in words}), np.int64)
            need = -(-template.percent * len(tokens) // 100)
            for place, token in enumerate(tokens[: len(tokens) - need + 1].tolist()):
                self.index[token].append((len(self.templates), place))
            self.templates.append(Prepared(template, words, tokens, need))
        self.indexed = np.zeros(len(order) + 1, bool)  # -1 finds the last
        self.indexed[list(self.index)] = True

    def blocks(self, words: list[bytes]) -> list[tuple[int, int, int, float]]:
        """``template, start, words, containment`` of every block that meets one."""
        ids = np.fromiter((self.rank.get(w, -1) for w in words), np.int64, len(words))
        found = []
        for number, hits in sorted(self.hits(ids).items()):
            one = self.templates[number]
            places = self.places(one, ids)
            starts = np.flatnonzero(np.logical_and.reduce(self.filters(one, hits, ids, places)))
            found += self.verified(number, starts, words, places)
        return found

    def hits(self, ids: np.ndarray) -> dict[int, list[tuple[int, np.ndarray]]]:
        """By template: its prefix words in a text, by place, and where they stand."""
        at = np.flatnonzero(self.indexed[ids])
        at = at[np.argsort(ids[at], kind="stable")]
        tokens, first = np.unique(ids[at], return_index=True)
        found = defaultdict(list)
        for token, where in zip(tokens.tolist(), np.split(at, first[1:]), strict=False):
            for number, place in self.index[token]:
                found[number].append((place, where))
        return found

    def places(self, one: Prepared, ids: np.ndarray) -> np.ndarray:
        """Each word's place in the order of a template, -1 for other words."""
        place = np.full(len(self.rank) + 1, -1)
        place[one.tokens] = np.arange(len(one.tokens))
        return place[ids]

    def filters(
        self, one: Prepared, hits: list[tuple[int, np.ndarray]], ids: np.ndarray, places: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which starts of blocks pass the prefix, length and positional filter."""
        width = min(one.width, len(ids))
        last = len(ids) - width

        def inside(marked: np.ndarray) -> np.ndarray:
            """How many marked words each block has, repeats counted."""
            sums = np.concatenate(([0], np.cumsum(marked)))
            return sums[width:] - sums[: last + 1]

        prefix, positional = np.zeros(last + 1, bool), np.zeros(last + 1, bool)
        for place, where in hits:
            edges = np.zeros(last + 2, np.int64)
            np.add.at(edges, np.maximum(where - width + 1, 0), 1)
            np.add.at(edges, np.minimum(where, last) + 1, -1)
            near = np.cumsum(edges)[:-1] > 0
            prefix |= near
            positional |= near & (1 + inside(places > place) >= one.need)
        return prefix, inside(ids >= 0) >= one.need, positional

    def verified(
        self, number: int, starts: np.ndarray, words: list[bytes], places: np.ndarray
    ) -> list[tuple[int, int, int, float]]:
        """The blocks at ``starts`` that meet a template by all of their words."""
        one, found = self.templates[number], []
        width = min(one.width, len(words))
        for start in starts.tolist():
            part = places[start : start + width]
            common = len(np.unique(part[part >= 0]))
            if common < one.need:
                continue
            if one.template.phrase and tuple(words[start : start + width]) != one.words:
                continue
            found.append((number, start, width, common / len(one.tokens)))
        return found


def word_frequency(docs: DataFrame, templates: tuple[Template, ...], text_column: str = "text") -> dict[bytes, int]:
    """How often all texts together have each word of the templates.

    Every document is counted; the result is bounded by the templates.
    """
    wanted = {w for t in templates for w in words_of(t.text)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["text"]:
                total.update(filter(wanted.__contains__, words_of(text)))
        if total:
            yield pd.DataFrame({"word": [w.decode() for w in total], "n": list(total.values())})

    counted = (
        docs.select(F.col(text_column).alias("text"))
        .mapInPandas(count, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    return {row["word"].encode(): row["n"] for row in counted}


COLUMNS = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, "
    "blocks array<struct<label:string,template:int,start:bigint,words:int,containment:double>>"
)


def scan(
    docs: DataFrame,
    base: tuple[Template, ...] = BASE,
    notices: tuple[Template, ...] = NOTICES,
    text_column: str = "text",
) -> DataFrame:
    """All rows with ``blocks``, every block that meets a template, and counts.

    ``n_base, first_word, last_word, base_labels`` tell of the ``base``
    templates, ``labels`` of all; ``score`` is the largest containment. A text
    without such a block has 0, NULL, NULL and empty labels; a NULL or empty
    text has no words; a text shorter than a template is one block. Whole texts
    are read and repeated rows scanned alike. All columns stay; the new ones
    replace columns of the same name.
    """
    templates = (*base, *notices)
    scanner = Scanner(templates, word_frequency(docs, templates, text_column))
    names = [part.split()[0] for part in COLUMNS.split(", ")]

    def find(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for text in batch:
                words = words_of(text)
                found = scanner.blocks(words)
                places = [start for number, start, _, _ in found if number < len(base)]
                labels = {templates[number].label for number, *_ in found}
                of_base = {base[number].label for number, *_ in found if number < len(base)}
                rows.append(
                    (
                        len(words),
                        len(places),
                        min(places, default=None),
                        max(places, default=None),
                        ",".join(sorted(of_base)),
                        ",".join(sorted(labels)),
                        max((share for *_, share in found), default=0.0),
                        [(templates[n].label, n, s, w, share) for n, s, w, share in found],
                    )
                )
            made = pd.DataFrame(rows, columns=names)
            yield made.astype({"first_word": "Int64", "last_word": "Int64"})

    udf = F.pandas_udf(find, COLUMNS)
    old = [c for c in docs.columns if c not in names]
    return docs.select(*old, udf(F.col(text_column)).alias("__found")).select(*old, "__found.*")

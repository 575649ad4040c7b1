"""Main text of web pages by a linear-chain conditional random field.

A page is cut into the leaf blocks of its tree. Elements above a block and the
form of its text are its features; a conditional random field over the chain of
blocks gives each the label main or other, and Viterbi finds the likeliest
labels of a whole page. It is trained on two kinds of labelled pages: a bounded
sample of the table, labelled by the elements above each block, and pages made
by :func:`labelled_page` in layouts that the sample may not have.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .html_blocks import Block, Element, blocks_of, features_of
from .labelled import bounded_sample

#: Pages of the table, and made pages, the field is trained on at most.
SAMPLE, MADE = 300, 500
#: Blocks of a page used in training; a longer page is trained on in parts.
PART = 80
STEPS, RATE, RIDGE = 60, 0.3, 1e-3
OTHER, MAIN = 0, 1

# --- Fixed values: elements and parts of names that are not the article. ---
OTHER_ELEMENTS = frozenset("nav header footer aside form button select menu dialog".split())
OTHER_NAMES = (
    "comment", "reply", "discuss", "cookie", "consent", "notice", "alert", "banner", "sidebar", "menu",
    "advert", "promo", "sponsor", "share", "social", "related", "recommend", "subscribe",
    "newsletter", "login", "search", "breadcrumb", "foot", "hidden",
)
OTHER_TOKENS = frozenset({"ad", "ads", "nav", "side"})


def labels_of(blocks: list[Block]) -> list[int]:
    """The labels the elements above the blocks tell; main only inside an article."""
    known: dict[int, tuple[bool, bool]] = {id(None): (False, False)}

    def judged(element: Element | None) -> tuple[bool, bool]:
        """Whether it is inside an article, and whether it is something else."""
        todo = []
        while id(element) not in known:
            todo.append(element)
            element = element.parent
        inside, other = known[id(element)]
        for own in reversed(todo):
            inside = inside or own.tag in ("article", "main")
            named = any(name in own.said for name in OTHER_NAMES) or OTHER_TOKENS & set(
                own.said.replace("-", " ").replace("_", " ").split()
            )
            tagged = own.tag in OTHER_ELEMENTS and not (own.tag == "header" and inside)
            other = bool(other or named or tagged)
            known[id(own)] = inside, other
        return inside, other

    return [MAIN if judged(block.inside) == (True, False) else OTHER for block in blocks]


def labelled_page(rng: random.Random, texts: list[str]) -> tuple[list[Block], list[int]]:
    """A made page in a random layout whose blocks are labelled as it is made.

    Texts are cut from ``texts``, so that their form is that of real ones.
    """

    def words(low: int, high: int) -> str:
        found = rng.choice(texts).split() or ["text"]
        size = rng.randint(low, high)
        start = rng.randrange(max(1, len(found) - size))
        return " ".join(found[start : start + size]) or "text"

    rows: list[tuple[str, int]] = []  # html and its label

    def other(html: str) -> None:
        rows.append((html, OTHER))

    def named(names: str) -> str:
        return rng.choice(names.split())

    def links(n: int) -> str:
        return "".join(f'<li><a href="/x">{words(1, 3)}</a></li>' for _ in range(n))

    def boxed(name: str, inner: str) -> str:
        tag = named("div section aside")
        if tag == "aside" and rng.random() < 0.5:
            return f"<aside>{inner}</aside>"
        return f'<{tag} {named("class id")}="{name}">{inner}</{tag}>'

    if rng.random() < 0.7:
        tag = named("nav nav div header")
        other(f'<{tag} class="{named("menu nav navbar main-nav top-menu")}"><ul>{links(rng.randint(3, 8))}</ul></{tag}>')
    if rng.random() < 0.5:
        other(f"<header><h2>{words(1, 4)}</h2><p>{words(2, 9)}</p></header>")
    if rng.random() < 0.4:
        other(boxed(named("cookie-banner cookie-notice consent notice alert"), f"<p>{words(6, 30)}</p><button>{words(1, 2)}</button>"))
    if rng.random() < 0.3:
        other(boxed(named("breadcrumb breadcrumbs"), f'<a href="/">{words(1, 2)}</a> / {words(1, 3)}'))

    inner: list[tuple[str, int]] = [(f"<h1>{words(3, 12)}</h1>", MAIN)]
    for _ in range(rng.randint(1, 9)):
        kind = rng.random()
        if kind < 0.75:
            inner.append((f"<p>{words(1, 120)}</p>", MAIN))
        elif kind < 0.82:
            inner.append((f"<{named('h2 h3')}>{words(2, 8)}</{named('h2 h3')}>", MAIN))
        elif kind < 0.88:
            items = "".join(f"<li>{words(2, 20)}</li>" for _ in range(rng.randint(2, 5)))
            inner.append((f"<ul>{items}</ul>", MAIN))
        elif kind < 0.92:
            inner.append((f"<blockquote>{words(8, 40)}</blockquote>", MAIN))
        else:
            name = named("ad ads advert advertisement promo sponsored share social newsletter related")
            inner.append((boxed(name, f"<p>{words(2, 25)}</p>"), OTHER))
    if rng.random() < 0.4:
        said = "".join(f'<div class="{named("comment reply")}"><p>{words(3, 50)}</p></div>' for _ in range(rng.randint(1, 5)))
        inner.append((boxed(named("comments comment-list discussion"), f"<h3>{words(1, 3)}</h3>{said}"), OTHER))
    around = rng.random()
    if around < 0.55:
        opening = "<article>"
    elif around < 0.7:
        opening = "<main><article>"
    elif around < 0.8:
        opening = "<main>"
    else:
        opening = f'<div class="{named("content article post entry-content post-body main story article-body")}">'
    rows += [(opening + html, label) for html, label in inner]

    if rng.random() < 0.5:
        other(boxed(named("sidebar side-bar right-sidebar widget"), f"<h3>{words(1, 4)}</h3><ul>{links(4)}</ul><p>{words(3, 30)}</p>"))
    if rng.random() < 0.5:
        said = "".join(f"<p>{words(2, 60)}</p>" for _ in range(rng.randint(1, 5)))
        other(boxed(named("comments comment-section replies disqus"), f"<h3>{words(1, 3)}</h3>{said}"))
    if rng.random() < 0.4:
        other(f'<form class="{named("search subscribe login newsletter contact")}"><label>{words(1, 5)}</label><button>{words(1, 2)}</button></form>')
    if rng.random() < 0.4:
        other(boxed(named("related recommended read-more"), f"<h3>{words(1, 3)}</h3><ul>{links(4)}</ul>"))
    if rng.random() < 0.4:
        other(boxed(named("ad ads advert banner sponsor"), words(3, 30)))
    if rng.random() < 0.8:
        other(f'<footer class="{named("footer site-footer foot")}"><p>© {words(1, 20)}</p></footer>')
    blocks: list[Block] = []
    labels: list[int] = []
    for html, label in rows:  # every piece stands by itself; its blocks share its label
        made = blocks_of(f"<html><body>{html}")
        blocks += made
        labels += [label] * len(made)
    return blocks, labels


@dataclass(frozen=True)
class Field:
    """Weights of features by label, of label pairs, and of the first label."""

    index: dict[str, int]
    emission: np.ndarray
    transition: np.ndarray
    first: np.ndarray

    def decode(self, blocks: list[Block]) -> list[int]:
        """The likeliest labels of a chain of blocks, by Viterbi."""
        back, score = [], None
        t = self.transition
        for names in features_of(blocks):
            at = [self.index[n] for n in names if n in self.index]
            own = self.emission[at].sum(axis=0)
            if score is None:
                score = self.first + own
                continue
            reach = score[:, None] + t
            back.append(reach.argmax(axis=0))
            score = reach.max(axis=0) + own
        if score is None:
            return []
        labels = [int(score.argmax())]
        for step in reversed(back):
            labels.append(int(step[labels[-1]]))
        return labels[::-1]


def train(pages: list[tuple[list[Block], list[int]]]) -> Field:
    """Maximise the penalised likelihood of labelled pages by AdaGrad."""
    parts = []
    for blocks, labels in pages:
        names = features_of(blocks)
        parts += [(names[k : k + PART], labels[k : k + PART]) for k in range(0, len(names), PART)]
    parts = [part for part in parts if part[0]]
    index: dict[str, int] = {}
    for names, _ in parts:
        for found in names:
            for name in found:
                index.setdefault(name, len(index))
    n, longest = len(parts), max((len(p[0]) for p in parts), default=0)
    emission, transition, first = np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2)
    if not n:
        return Field(index, emission, transition, first)
    lengths = np.array([len(p[0]) for p in parts])
    y = np.zeros((n, longest), np.int64)
    feature, cell = [], []
    for k, (names, labels) in enumerate(parts):
        y[k, : len(labels)] = labels
        for step, found in enumerate(names):
            feature += [index[name] for name in found]
            cell += [k * longest + step] * len(found)
    feature, cell = np.array(feature), np.array(cell)
    inside = np.arange(longest)[None, :] < lengths[:, None]
    truth = np.zeros((n, longest, 2))
    truth[np.arange(n)[:, None], np.arange(longest)[None, :], y] = 1
    truth *= inside[:, :, None]
    seen_pairs = np.einsum("nta,ntb->ab", truth[:, :-1], truth[:, 1:])
    squares = [np.full_like(a, 1e-8) for a in (emission, transition, first)]
    for _ in range(STEPS):
        own = np.stack(
            [np.bincount(cell, emission[feature, c], n * longest) for c in (0, 1)], axis=1
        ).reshape(n, longest, 2)
        ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = first + own[:, 0]
        for t in range(1, longest):
            reach = np.logaddexp.reduce(ahead[:, t - 1, :, None] + transition[None], axis=1)
            ahead[:, t] = reach + own[:, t]
        for t in range(longest - 2, -1, -1):
            reach = np.logaddexp.reduce(
                transition[None] + (own[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2
            )
            behind[:, t] = np.where(inside[:, t + 1, None], reach, 0)
        total = np.logaddexp.reduce(ahead[np.arange(n), lengths - 1], axis=1)
        share = np.exp(ahead + behind - total[:, None, None]) * inside[:, :, None]
        pairs = np.exp(
            ahead[:, :-1, :, None]
            + transition[None, None]
            + (own + behind)[:, 1:, None, :]
            - total[:, None, None, None]
        ) * inside[:, 1:, None, None]
        error = (share - truth).reshape(-1, 2)
        gradients = [
            np.stack([np.bincount(feature, error[cell, c], len(index)) for c in (0, 1)], axis=1) / n
            + RIDGE * emission,
            (pairs.sum(axis=(0, 1)) - seen_pairs) / n,
            (share[:, 0] - truth[:, 0]).sum(axis=0) / n,
        ]
        for value, gradient, square in zip(
            (emission, transition, first), gradients, squares, strict=True
        ):
            square += gradient**2
            value -= RATE * gradient / np.sqrt(square)
    return Field(index, emission, transition, first)


def fit(
    pages: DataFrame,
    sample: int = SAMPLE,
    made: int = MADE,
    html_column: str = "html",
    order: str = "page_id",
) -> Field:
    """Train on at most ``sample`` rows of the table and ``made`` pages."""
    rows = bounded_sample(pages.select(F.col(order), F.col(html_column).alias("html")), sample, order)
    real = [blocks_of(row["html"]) for row in rows.collect()]
    labelled = [(blocks, labels_of(blocks)) for blocks in real]
    labelled = [(b, y) for b, y in labelled if MAIN in y]  # others tell nothing of an article
    texts = [b.text for blocks, y in labelled for b, m in zip(blocks, y, strict=True) if m == MAIN]
    rng = random.Random(17)
    invented = [labelled_page(rng, texts or ["Some words of a text."]) for _ in range(made)]
    return train(labelled + invented)


def extract(pages: DataFrame, field: Field, html_column: str = "html") -> DataFrame:
    """All rows with ``text``, the main blocks joined by newlines, and ``n_chars``.

    Character references are decoded, white space inside a block becomes one
    space. A NULL or empty page, or one without main blocks, has an empty text.
    Whole pages are read, broken ones as far as they can be; repeated rows give
    repeated results. All columns stay; the new ones replace columns of the
    same name.
    """

    def find(htmls: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in htmls:
            texts = []
            for html in batch:
                blocks = blocks_of(html)
                labels = field.decode(blocks)
                main = [b.text for b, label in zip(blocks, labels, strict=True) if label == MAIN]
                texts.append("\n".join(main))
            yield pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})

    udf = F.pandas_udf(find, "text string, n_chars bigint")
    old = [c for c in pages.columns if c not in ("text", "n_chars")]
    return pages.select(*old, udf(F.col(html_column)).alias("__found")).select(*old, "__found.*")

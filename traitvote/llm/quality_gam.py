"""Quality classifier: a generalised additive model with pairwise terms.

Each measure of a text is cut into bins. Cyclic boosting goes round the
measures again and again and adds a little of a shallow tree, fitted to what is
still unexplained, to the measure's own lookup table; afterwards it does the
same with tables of the pairs that explain most of the rest. A score is the sum
of looked-up values, so every part of it can be read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import bucket_of
from .labelled import labelled_texts
from .text_stats import STATS, Words, stats

#: Labelled rows the model is fitted on at most.
SAMPLE = 12_000
BINS, PAIR_BINS, PAIRS = 32, 8, 10
ROUNDS, PAIR_ROUNDS = 150, 60
RATE, RIDGE = 0.1, 1.0
THRESHOLD = 0.3
HELD_OUT_FOLD, FOLDS = 0, 5


def is_held_out(doc_id: Column) -> Column:
    return bucket_of(doc_id, FOLDS) == HELD_OUT_FOLD


@dataclass(frozen=True)
class AdditiveModel:
    """``edges[j]`` cuts measure j into bins and ``tables[j]`` has their values.

    ``pairs`` holds (i, j, edges of i, edges of j, table).
    """

    bias: float
    edges: tuple[np.ndarray, ...]
    tables: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int, np.ndarray, np.ndarray, np.ndarray], ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the rows of a matrix of measures."""
        z = np.full(len(x), self.bias)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += table[np.searchsorted(edges, x[:, j], side="right")]
        for i, j, cut_i, cut_j, table in self.pairs:
            at = np.searchsorted(cut_i, x[:, i], side="right")
            z += table[at, np.searchsorted(cut_j, x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values of the bins by a tree of ordered splits on summed gradients."""
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h)
        k = int(np.argmax(gains)) + 1
        if gains[k - 1] > _gain(g.sum(), h.sum()) + 1e-9:
            return np.concatenate([_tree(g[:k], h[:k], depth - 1), _tree(g[k:], h[k:], depth - 1)])
    return np.full(len(g), -g.sum() / (h.sum() + RIDGE))


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best cut of a grid into four by a row and a column."""
    sums = [np.pad(np.cumsum(np.cumsum(a, 0), 1), ((1, 0), (1, 0))) for a in (g, h)]
    rows, cols = g.shape
    best, found = -np.inf, np.zeros_like(g)
    for r in range(1, rows):
        for c in range(1, cols):
            parts = [
                (s[r, c], s[r, cols] - s[r, c], s[rows, c] - s[r, c],
                 s[rows, cols] - s[r, cols] - s[rows, c] + s[r, c])
                for s in sums
            ]
            gg, hh = np.array(parts[0]), np.array(parts[1])
            gain = _gain(gg, hh).sum()
            if gain > best:
                best, values = gain, -gg / (hh + RIDGE)
                found = np.empty_like(g)
                found[:r, :c], found[:r, c:], found[r:, :c], found[r:, c:] = values
    return float(best - _gain(g.sum(), h.sum())), found


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner edges of bins with about as many rows each."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def boost(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Fit to the rows of ``x`` with labels ``y`` of both kinds."""
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    measures = range(x.shape[1])
    edges = [_cuts(x[:, j], BINS) for j in measures]
    at = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    z = np.full(len(x), bias)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for j in measures:
            g, h = gradients()
            size = len(tables[j])
            step = RATE * _tree(np.bincount(at[j], g, size), np.bincount(at[j], h, size))
            tables[j] += step
            z += step[at[j]]

    coarse = [_cuts(x[:, j], PAIR_BINS) for j in measures]
    place = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]
    g, h = gradients()

    def grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
        shape = len(coarse[i]) + 1, len(coarse[j]) + 1
        flat = place[i] * shape[1] + place[j]
        return np.bincount(flat, values, shape[0] * shape[1]).reshape(shape)

    usable = [j for j in measures if len(coarse[j])]
    gains = [(_quadrants(grid(i, j, g), grid(i, j, h))[0], i, j) for i, j in combinations(usable, 2)]
    chosen = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    grids = {pair: np.zeros((len(coarse[pair[0]]) + 1, len(coarse[pair[1]]) + 1)) for pair in chosen}
    for _ in range(PAIR_ROUNDS):
        for i, j in chosen:
            g, h = gradients()
            step = RATE * _quadrants(grid(i, j, g), grid(i, j, h))[1]
            grids[i, j] += step
            z += step[place[i], place[j]]
    pairs = tuple((i, j, coarse[i], coarse[j], grids[i, j]) for i, j in chosen)
    return AdditiveModel(bias, tuple(edges), tuple(tables), pairs)


def _measure(texts: pd.Series, words: Words) -> np.ndarray:
    rows = [stats(text or "", words) for text in texts]
    return np.array(rows, np.float64).reshape(len(rows), len(STATS))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AdditiveModel:
    """Fit on at most ``sample`` labelled documents; measures are taken in tasks.

    Without labels of both kinds every text gets the share of good ones
    (one half without any label).
    """

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            x = list(_measure(batch["text"], words))
            yield batch[["doc_id", "quality"]].assign(x=x)

    schema = "doc_id bigint, quality int, x array<double>"
    rows = labelled_texts(docs, labels, sample).mapInPandas(measure, schema).toPandas()
    rows = rows.sort_values("doc_id", ignore_index=True)
    y = rows["quality"].to_numpy(np.float64)
    if len(set(y)) < 2:
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6) if len(y) else 0.5
        return AdditiveModel(float(np.log(share / (1 - share))), (), (), ())
    return boost(np.vstack(rows["x"].to_numpy()), y)


def score(
    docs: DataFrame,
    model: AdditiveModel,
    text_column: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """All rows with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold``).

    The whole text is measured; NULL and empty texts are measured as zeros and
    scored like any other, repeated rows are scored alike. All columns stay;
    the two new ones replace columns of the same name.
    """

    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = Words()
        for batch in texts:
            yield pd.Series(model.score(_measure(batch, words)))

    udf = F.pandas_udf(scores, "double")
    new = {"score", "predicted"}
    old = [c for c in docs.columns if c not in new]
    scored = docs.select(*old, udf(F.col(text_column)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

"""Quality rules: fixed counts, and a logistic regression on hashed n-grams.

The regression sees words, pairs of words and runs of characters, each hashed
to a bucket; a feature is a bucket's share among those of its kind. It is
trained on a bounded sample of labelled rows; a quarter of the sample is kept
apart to calibrate its probabilities. Texts are scored in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .features import code_points, gram_buckets
from .labelled import labelled_texts
from .text_stats import SYMBOLS, Words, count_of, covered_by_repeats, repeated_lines, word_chars

#: Labelled rows the regression is fitted on at most.
SAMPLE = 3000
BUCKETS = 1 << 16
CHAR_SIZES = (1, 2, 3)
#: Features are shares and so small; this makes their weights learn faster.
SCALE = 30.0
STEPS, RATE, RIDGE = 60, 0.3, 1e-4
#: Fixed thresholds.
KEEP_PROBABILITY = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def features(text: str, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of a text and the share each occurrence has."""
    hashes = words.hashes(words.split(text))
    pairs = hashes[1:] * np.uint64(0x9E3779B97F4A7C15) + hashes[:-1]
    of_words = (np.concatenate([hashes, pairs]) >> np.uint64(40)).astype(np.int64)
    codes = code_points(text)
    of_chars = np.concatenate([gram_buckets(codes, n, BUCKETS, n) for n in CHAR_SIZES])
    buckets = np.concatenate([of_words % BUCKETS, BUCKETS + of_chars])
    shares = np.concatenate(
        [np.full(len(part), SCALE / max(1, len(part))) for part in (of_words, of_chars)]
    )
    return buckets, shares


@dataclass(frozen=True)
class Regression:
    """Weights of all buckets; ``slope`` and ``offset`` calibrate their sum."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def probability(self, sums: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * (sums + self.bias) + self.offset, -30, 30)
        return 1 / (1 + np.exp(-z))

    def score(self, text: str, words: Words) -> float:
        buckets, shares = features(text, words)
        return float(self.probability(np.array(self.weights[buckets] @ shares)))


def _collect(rows: DataFrame) -> pd.DataFrame:
    """``doc_id, quality, buckets, shares`` of a sample, on the driver."""

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            made = []
            for text in batch["text"]:
                buckets, shares = features(text or "", words)
                at, where = np.unique(buckets, return_inverse=True)
                sums = np.bincount(where, shares) if len(at) else np.empty(0)
                made.append((at.astype(np.int32).tobytes(), sums.astype(np.float32).tobytes()))
            columns = pd.DataFrame(made, columns=["buckets", "shares"], index=batch.index)
            yield pd.concat([batch[["doc_id", "quality"]], columns], axis=1)

    # bytes stay as compact on the driver as they were in the tasks
    schema = "doc_id bigint, quality int, buckets binary, shares binary"
    found = rows.mapInPandas(extract, schema).toPandas()
    return found.sort_values("doc_id", ignore_index=True)


def _calibrate(sums: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through held-out sums, by Newton steps."""
    # Softened targets keep the curve finite where the classes do not overlap.
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    spread = max(1e-9, float(np.abs(sums).mean()))
    x = np.column_stack([sums / spread, np.ones(len(sums))])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - target) + 1e-3 * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta - step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / spread), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Regression:
    """Fit on at most ``sample`` labelled documents.

    Without labels of both kinds nothing can be told apart: every text then
    gets the share of good ones (1 without any label).
    """
    rows = _collect(labelled_texts(docs, labels, sample))
    y = rows["quality"].to_numpy(np.float64)
    if len(set(y)) < 2:
        share = float(y.mean()) if len(y) else 1.0
        bias = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return Regression(np.zeros(2 * BUCKETS, np.float32), bias)
    apart = np.arange(len(rows)) % 4 == 3
    if len(set(y[apart])) < 2 or len(set(y[~apart])) < 2:
        apart[:] = False
    train = np.flatnonzero(~apart)
    parts = [
        (np.frombuffer(at, np.int32), np.frombuffer(shares, np.float32))
        for at, shares in zip(rows["buckets"], rows["shares"], strict=True)
    ]
    del rows
    good = y[train].mean()
    each = np.where(y[train] == 1, 0.5 / good, 0.5 / (1 - good))  # classes weigh the same
    weights, squares, bias = np.zeros(2 * BUCKETS), np.full(2 * BUCKETS, 1e-8), 0.0
    for _ in range(STEPS):
        gradient, shift = RIDGE * weights, 0.0
        for k, weight in zip(train, each, strict=True):
            at, shares = parts[k]
            z = min(30.0, max(-30.0, float(weights[at] @ shares) + bias))
            error = weight * (1 / (1 + np.exp(-z)) - y[k]) / len(train)
            gradient[at] += error * shares  # a text has each bucket once
            shift += error
        squares += gradient**2
        weights -= RATE * gradient / np.sqrt(squares)
        bias -= shift
    held = np.flatnonzero(apart) if apart.any() else train
    held_sums = np.array([weights[parts[k][0]] @ parts[k][1] for k in held])
    slope, offset = _calibrate(held_sums + bias, y[held])
    return Regression(weights.astype(np.float32), bias, slope, offset)


RULE_COLUMNS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, quality double, kept boolean"
)


def judge(
    docs: DataFrame,
    model: Regression,
    text_column: str = "text",
    keep_probability: float = KEEP_PROBABILITY,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
) -> DataFrame:
    """All rows with the counts, ``base_failed``, ``quality`` and ``kept``.

    A text fails the base rules with fewer than ``min_words`` words or with
    more than ``max_repeat_percent`` of its words in runs of three that it
    repeats; a NULL or empty text has no words and fails. ``quality`` is the
    calibrated probability; a row is kept where it passes the base rules and
    reaches ``keep_probability``. Whole texts are read; repeated rows are
    judged alike. All columns stay; the new ones replace those of the same
    name.
    """
    names = [part.split()[0] for part in RULE_COLUMNS.split(", ")]

    def rules(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in texts:
            rows = []
            for value in batch:
                text = value or ""
                split = words.split(text)
                n, repeats = len(split), covered_by_repeats(words.hashes(split))
                failed = n < min_words or 100 * repeats > max_repeat_percent * n
                quality = model.score(text, words)
                counts = (n, word_chars(text), count_of(text, SYMBOLS), repeated_lines(text), repeats)
                rows.append((*counts, failed, quality, not failed and quality >= keep_probability))
            yield pd.DataFrame(rows, columns=names)

    old = [c for c in docs.columns if c not in names]
    udf = F.pandas_udf(rules, RULE_COLUMNS)
    return docs.select(*old, udf(F.col(text_column)).alias("__rules")).select(*old, "__rules.*")

"""Languages of a text as a mixture, by expectation-maximisation.

A model holds for each language the likelihood of every hashed letter n-gram.
A text is taken for a mixture of languages: expectation-maximisation finds the
proportions that make its n-grams likeliest. The set of languages is chosen by
penalised likelihood: from all of them the one with the smallest proportion is
left out again and again, and the set with the best likelihood less penalty
wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import bucket_of, table
from .features import code_points, gram_buckets

UNKNOWN = "und"
#: Buckets of hashed n-grams of one to three letters; a word begins and ends with a space.
BUCKETS = 1 << 15
SIZES = (1, 2, 3)
#: Labelled documents a model is learned from at most, for each language.
SAMPLE = 2000
#: Added to each count, so that no n-gram rules a language out.
SMOOTHING = 0.5
MAX_STEPS = 25
#: A further language has to gain so many times the logarithm of the number
#: of n-grams; neighbouring n-grams overlap, so one half would be too little.
PENALTY = 3.0
HELD_OUT_FOLD, FOLDS = 2, 4


def is_held_out(doc_id: Column) -> Column:
    return bucket_of(doc_id, FOLDS) == HELD_OUT_FOLD


_SPACES = np.uint32(32)


def grams_of(text: str) -> np.ndarray:
    """Buckets of all n-grams over the letters of a text, in lower case.

    What is no letter parts words; runs of it count as one space.
    """
    lowered = "".join(c if c.isalpha() else " " for c in text.lower()) if not text.isascii() else None
    if lowered is None:
        codes = _ASCII[np.frombuffer(text.encode(), np.uint8)]
    else:
        codes = code_points(lowered)
    space = codes == _SPACES
    codes = codes[~(space & np.concatenate(([True], space[:-1])))]
    codes = np.concatenate(([_SPACES], codes, [_SPACES])).astype(np.uint32)
    return np.concatenate([gram_buckets(codes, n, BUCKETS, n) for n in SIZES])


_ASCII = np.array(
    [ord(chr(c).lower()) if chr(c).isalpha() and c < 128 else 32 for c in range(256)], np.uint32
)


@dataclass(frozen=True)
class LanguageModel:
    """``log_likelihood`` has a row for each of ``languages``."""

    languages: tuple[str, ...]
    log_likelihood: np.ndarray


def fit(docs: DataFrame, sample: int = SAMPLE, order: str = "doc_id") -> LanguageModel:
    """Learn from the rows of ``text, lang`` with a language.

    About ``sample`` rows of each language are used at most, those with the
    smallest hash of ``order``. Counts are summed in the tasks; what reaches the driver
    is one table of buckets by language.
    """
    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL").withColumn(
        "__order", F.xxhash64(order)
    )
    sizes = known.groupBy("lang").count().orderBy("lang").collect()
    chosen = None
    for row in sizes:  # one filter for each language; there are few
        span = min(1.0, sample / row["count"])
        limit = min(2**63 - 1, int(-(2**63) + span * 2**64))
        part = (F.col("lang") == row["lang"]) & (F.col("__order") <= F.lit(limit).cast("bigint"))
        chosen = part if chosen is None else chosen | part
    if chosen is None:
        return LanguageModel((), np.zeros((0, BUCKETS), np.float32))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                total += np.bincount(grams_of(text), minlength=BUCKETS)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": total[at]})

    counted = (
        known.filter(chosen)
        .select("lang", "text")
        .mapInPandas(count, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = tuple(sorted(row["lang"] for row in sizes))
    counts = np.full((len(languages), BUCKETS), SMOOTHING)
    for k, language in enumerate(languages):
        own = counted[counted["lang"] == language]
        counts[k, own["bucket"].to_numpy()] += own["n"].to_numpy()
    likelihood = np.log(counts / counts.sum(axis=1, keepdims=True))
    return LanguageModel(languages, likelihood.astype(np.float32))


def _mixture(likelihood: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions of the rows of ``likelihood`` and log likelihood of the mixture.

    ``likelihood`` is scaled so that the largest value of a column is one.
    """
    size = len(likelihood)
    weights = np.full(size, 1 / size)
    if size == 1:
        return weights, float(counts @ np.log(likelihood[0]))
    total = counts.sum()
    for _ in range(MAX_STEPS):
        mixed = weights @ likelihood
        new = weights * (likelihood @ (counts / mixed)) / total
        moved = np.abs(new - weights).max()
        weights = new
        if moved < 1e-3:
            break
    return weights, float(counts @ np.log(weights @ likelihood))


def infer(model: LanguageModel, text: str) -> dict[str, float]:
    """The chosen languages of a text with letters and their proportions."""
    buckets, counts = np.unique(grams_of(text), return_counts=True)
    counts = counts.astype(np.float64)
    logs = model.log_likelihood[:, buckets].astype(np.float64)
    likelihood = np.exp(logs - logs.max(axis=0))
    likelihood = np.maximum(likelihood, 1e-12)
    left = np.arange(len(model.languages))
    penalty = PENALTY * np.log(counts.sum())
    best_score, best = -np.inf, {}
    while True:
        weights, log_likelihood = _mixture(likelihood[left], counts)
        score = log_likelihood - penalty * len(left)
        if score > best_score:
            best_score = score
            best = dict(zip(left.tolist(), weights.tolist(), strict=True))
        if len(left) == 1:
            break
        # languages with next to nothing go at once, else the smallest one
        going = weights < 1e-3
        going[np.argmin(weights)] = True
        going[np.argmax(weights)] = False
        left = left[~going]
    return {model.languages[k]: w for k, w in best.items()}


def identify(
    docs: DataFrame, model: LanguageModel, text_column: str = "text"
) -> DataFrame:
    """All rows with ``lang_pred, lang_score, lang_mixture``.

    ``lang_pred`` is the language with the largest proportion (the first by
    name of equals), ``lang_score`` this proportion and ``lang_mixture`` all
    chosen languages with theirs. A text that is NULL or has no letter is
    ``und`` with score 0, as is every text under a model without languages.
    The whole text is read. All columns stay; the new ones replace columns of
    the same name.
    """

    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for text in batch:
                if not text or not model.languages or not any(map(str.isalpha, text)):
                    rows.append((UNKNOWN, 0.0, {}))
                    continue
                found = infer(model, text)
                name = max(sorted(found), key=found.__getitem__)
                rows.append((name, min(1.0, found[name]), found))
            yield pd.DataFrame(rows, columns=["lang_pred", "lang_score", "lang_mixture"])

    udf = F.pandas_udf(
        predict, "lang_pred string, lang_score double, lang_mixture map<string,double>"
    )
    new = ["lang_pred", "lang_score", "lang_mixture"]
    old = [c for c in docs.columns if c not in new]
    found = docs.select(*old, udf(F.col(text_column)).alias("__found"))
    return found.select(*old, "__found.*")


def fitted_for(spark: SparkSession, sf_dir: str) -> LanguageModel:
    """The model learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return fit(docs.filter(~is_held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))

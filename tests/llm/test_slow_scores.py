"""Scores of the learned operators against slow, plain re-computations."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from itertools import combinations

import numpy as np
import pytest
import xxhash
from conftest import TESTDATA
from pyspark.sql import functions as F

from traitvote.llm import QUERIES, language_id, quality_gam, quality_rules
from traitvote.llm.features import gram_buckets
from traitvote.llm.text_stats import Words, stats

SF = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels")}


@pytest.fixture(scope="module")
def texts(tables):
    return {r.doc_id: r.text for r in tables["documents"].collect()}


def plain_buckets(codes, size, buckets, seed):
    """The hashes of :func:`gram_buckets` in whole numbers, one run after the other."""
    low, out = (1 << 32) - 1, []
    for start in range(len(codes) - size + 1):
        h = (codes[start] * 2_654_435_761 + seed) & low
        for code in codes[start + 1 : start + size]:
            h = (((h ^ (h >> 15)) * 2_246_822_519 & low) + code * 3_266_489_917) & low
        h ^= h >> 16
        h = h * 2_654_435_761 & low
        h ^= h >> 13
        out.append(h & (buckets - 1))
    return out


def test_buckets_of_runs():
    codes = [32, 104, 228, 0x1F600, 32, 116, 101, 32]
    for size in (1, 2, 3, 9):
        got = gram_buckets(np.array(codes, np.uint32), size, 1 << 15, size)
        assert got.tolist() == plain_buckets(codes, size, 1 << 15, size)


# --- Language ID -------------------------------------------------------------------------


def mixture(likelihoods, counts):
    """Proportions by expectation-maximisation until they stand still, and log likelihood."""
    weights = np.full(len(likelihoods), 1 / len(likelihoods))
    for _ in range(400):
        parts = weights[:, None] * likelihoods
        new = (parts / parts.sum(axis=0) * counts).sum(axis=1) / counts.sum()
        if np.abs(new - weights).max() < 1e-7:
            break
        weights = new
    return weights, float((counts * np.log(weights @ likelihoods)).sum())


def test_languages_are_those_of_the_best_of_all_sets(spark, texts):
    model = language_id.fitted_for(spark, SF)
    got = {r.doc_id: r for r in QUERIES["op4_language_id"](spark, SF).collect()}
    n_languages, compared = len(model.languages), 0
    for doc_id, text in sorted(texts.items())[:70]:
        if not any(c.isalpha() for c in text or ""):
            assert (got[doc_id].lang_pred, got[doc_id].score) == ("und", 0.0)
            continue
        buckets, counts = np.unique(language_id.grams_of(text), return_counts=True)
        logs = model.log_likelihood[:, buckets].astype(float)
        every = np.maximum(np.exp(logs - logs.max(axis=0)), 1e-12)
        best = None
        for size in range(1, n_languages + 1):
            for chosen in combinations(range(n_languages), size):
                weights, likelihood = mixture(every[list(chosen)], counts.astype(float))
                score = likelihood - language_id.PENALTY * math.log(counts.sum()) * size
                if best is None or score > best[0]:
                    best = score, dict(zip((model.languages[k] for k in chosen), weights, strict=True))
        name = max(sorted(best[1]), key=best[1].get)
        assert got[doc_id].lang_pred == name
        assert got[doc_id].score == pytest.approx(best[1][name], abs=0.02)
        compared += 1
    assert compared > 50


# --- Quality -------------------------------------------------------------------------------


def test_additive_scores_are_sums_of_looked_up_values(spark, tables, texts):
    held_out = quality_gam.is_held_out(F.col("doc_id"))
    model = quality_gam.fit(tables["documents"], tables["labels"].filter(~held_out))
    assert len(model.tables) > 10 and model.pairs
    words = Words()
    for r in QUERIES["op8_quality_classifier"](spark, SF).collect():
        x = list(stats(texts[r.doc_id] or "", words))
        z = model.bias
        for value, edges, table in zip(x, model.edges, model.tables, strict=True):
            z += table[bisect_right(list(edges), value)]
        for i, j, cut_i, cut_j, table in model.pairs:
            z += table[bisect_right(list(cut_i), x[i])][bisect_right(list(cut_j), x[j])]
        score = 1 / (1 + math.exp(-max(-30, min(30, z))))
        assert r.score == pytest.approx(score, abs=1e-9) and r.predicted == (score >= 0.3)


def test_regression_scores_are_weighted_shares(spark, tables, texts):
    model = quality_rules.fit(tables["documents"], tables["labels"])
    n = quality_rules.BUCKETS
    found = {r.doc_id: r for r in QUERIES["op6_quality_rules"](spark, SF).collect()}
    for doc_id, text in sorted(texts.items())[:40]:
        text = text or ""
        hashes = [xxhash.xxh64_intdigest(w.encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
        pairs = [(b * 0x9E3779B97F4A7C15 + a) & (2**64 - 1) for a, b in zip(hashes, hashes[1:], strict=False)]
        of_words = [(h >> 40) % n for h in hashes + pairs]
        codes = [ord(c) for c in text]
        of_chars = [n + b for size in quality_rules.CHAR_SIZES for b in plain_buckets(codes, size, n, size)]
        z = model.bias
        for part in (of_words, of_chars):
            z += sum(float(model.weights[b]) for b in part) * quality_rules.SCALE / max(1, len(part))
        z = model.slope * z + model.offset
        r = found[doc_id]
        assert r.quality == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-4)
        assert r.kept == (not r.base_failed and r.quality >= quality_rules.KEEP_PROBABILITY)

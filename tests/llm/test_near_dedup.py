"""Near duplicates, their parts, and the pipeline."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from conftest import TESTDATA
from hard_cases import docs, fresh, hard, nothing  # noqa: F401

from traitvote import Stages
from traitvote.llm import near_dedup
from traitvote.llm.common import ROW_KEY

SF = str(TESTDATA / "sf0.001")


def brute_force(texts):
    """component by id of texts, from all pairs that share a shingle."""
    sets, where = {}, defaultdict(list)
    for i, text in texts.items():
        words = near_dedup.words_of(text)
        runs = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        sets[i] = set(runs) if runs else {tuple(words)} if words else set()
        for s in sets[i]:
            where[s].append(i)
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in sets.items():
        for j, both in Counter(j for s in own for j in where[s] if j < i).items():
            if 100 * both >= 75 * (len(own) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in texts}


def found(df):
    return {r[ROW_KEY[0]]: (r.n_shingles, r.component_id) for r in df.collect()}


def test_planted_copies_against_brute_force(docs, stages):
    rng, texts = random.Random(4), {}
    for base in range(12):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 8, 60, 200]))]
        for _ in range(rng.choice([1, 5, 40])):
            edited = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                edited[rng.randrange(len(words))] = f"v{rng.randrange(500)}"
            texts[len(texts) * 3 + 1] = " ".join(edited)
        # a chain: each is near the one before only
        for step in range(3):
            words = words[len(words) // 9 :] + [f"c{base}_{step}_{k}" for k in range(len(words) // 9)]
            texts[len(texts) * 3 + 1] = " ".join(words).upper()
    got = found(near_dedup.near_duplicates(docs(*texts.items()), stages))
    assert got == brute_force(texts)


@pytest.mark.parametrize("large", [500, 3])
def test_many_mixed_buckets(docs, stages, monkeypatch, large):
    monkeypatch.setattr(near_dedup, "OUTSIDE", 2)
    monkeypatch.setattr(near_dedup, "LARGE", large)
    rng, texts = random.Random(5), {}
    shared = [f"s{k}" for k in range(60)]
    for i in range(120):  # half of each text is shared: many candidates, few links
        own = [f"o{i // 2}_{k}" for k in range(rng.choice([12, 30]))]
        texts[i] = " ".join(shared + own)
    assert found(near_dedup.near_duplicates(docs(*texts.items()), stages)) == brute_force(texts)


def test_a_bucket_of_thousands_loses_no_link(docs, stages, monkeypatch):
    """Classes that share one band only are compared, however many are in it."""
    band_keys = near_dedup.band_keys

    def one_band(least):  # all texts meet in the first band and nowhere else
        keys = band_keys(least)
        keys[1:] ^= least[1:43].view("int64")
        keys[0] = 7
        return keys

    monkeypatch.setattr(near_dedup, "band_keys", one_band)
    rng, texts = random.Random(8), {}
    for i in range(2_050):
        words = [f"g{i // 2}_{k}" for k in range(40)]
        if i % 2:  # a pair has 30 or 31 of 42 shingles in common: near the threshold
            words = words[rng.choice([5, 6]) :] + [f"n{i}"]
        texts[i] = " ".join(words)
    assert found(near_dedup.near_duplicates(docs(*texts.items()), stages)) == brute_force(texts)


def test_a_group_of_near_copies_takes_few_pairs(docs, stages, monkeypatch):
    pairs, compare = [], near_dedup._Search.compare

    def counted(self, rows):
        pairs.append(rows.count())
        return compare(self, rows)

    monkeypatch.setattr(near_dedup._Search, "compare", counted)
    rng, texts = random.Random(9), {}
    words = [f"w{k}" for k in range(120)]
    for i in range(300):
        edited = list(words)
        edited[rng.randrange(120)] = f"e{i}"
        texts[i] = " ".join(edited)
    assert found(near_dedup.near_duplicates(docs(*texts.items()), stages)) == brute_force(texts)
    assert sum(pairs) < 2 * len(texts)


@pytest.mark.parametrize("marks", [(8, 4_096), (1, 1)])
def test_a_group_around_the_threshold_takes_few_pairs(docs, stages, monkeypatch, marks):
    """Many pairs of the group are links or nearly so; few marks only rule out fewer."""
    monkeypatch.setattr(near_dedup, "MARK_BYTES", marks, raising=False)
    verified, confirm, compare = [], near_dedup._Search.confirm, near_dedup._Search.compare

    def counted(self, pairs):
        verified.append(pairs.count())
        return confirm(self, pairs)

    def with_leaders(self, pairs):
        before, n_links = len(verified), compare(self, pairs)
        del verified[before:]
        return n_links

    monkeypatch.setattr(near_dedup._Search, "confirm", counted)
    monkeypatch.setattr(near_dedup._Search, "compare", with_leaders)
    rng, texts = random.Random(10), {}
    words = [f"w{k}" for k in range(120)]
    for i in range(400):
        edited = list(words)
        for k in rng.sample(range(120), rng.choice([1, 3, 3, 4])):
            edited[k] = f"e{rng.randrange(30)}"
        texts[i] = " ".join(edited)
    assert found(near_dedup.near_duplicates(docs(*texts.items()), stages)) == brute_force(texts)
    assert verified
    if marks != (1, 1):  # 3,303 pairs when all that promise are verified at once
        assert sum(verified) < len(texts)


def test_a_class_is_sent_to_its_bucket_once(docs, stages, monkeypatch, tmp_path):
    """Not once for each class of the others, which took an executor gigabytes."""
    band_keys, prune_outer = near_dedup.band_keys, near_dedup._prune_outer

    def one_band(least):  # all texts meet in the first band and nowhere else
        keys = band_keys(least)
        keys[1:] ^= least[1:43].view("int64")
        keys[0] = 7
        return keys

    def logged(*options):
        def prune(batches):
            for batch in batches:
                cells = (x for c in batch if c.startswith("signature") for x in batch[c])
                with open(tmp_path / "sent", "a") as sent:
                    sent.write(f"{sum(1 if isinstance(x, bytes) else len(x) for x in cells)}\n")
                yield from prune_outer(*options)(iter([batch]))

        return prune

    monkeypatch.setattr(near_dedup, "band_keys", one_band)
    monkeypatch.setattr(near_dedup, "_prune_outer", logged)
    texts = {i: " ".join(f"w{i}_{k}" for k in range(40)) for i in range(80)}
    assert found(near_dedup.near_duplicates(docs(*texts.items()), stages)) == brute_force(texts)
    # 6,400 when each class came with a list of all others
    assert sum(map(int, (tmp_path / "sent").read_text().split())) == 80 + 79


def test_near_dedup_hard_cases(hard, nothing, stages):
    result = near_dedup.near_duplicates(hard((9, "NO id\tat all"), (10, "ONE")), stages)
    rows = [(r[ROW_KEY[0]], r.n_shingles, r.component_id, r.kept) for r in result.collect()]
    assert sorted(rows, key=repr) == sorted(
        [
            (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True),
            (None, 1, 9, False), (None, 0, None, True), (5, 1, 5, True), (9, 1, 9, True), (10, 1, 4, False),
        ],
        key=repr,
    )
    kept = near_dedup.keep_one(hard((9, "NO id\tat all")), fresh(stages))
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, 5, 9, None])
    assert kept.columns == hard().columns
    assert near_dedup.near_duplicates(nothing, fresh(stages)).count() == 0


def test_pruning_keeps_to_the_miss_probability():
    rng = np.random.default_rng(6)
    for similarity in (0.75, 0.8, 0.95):
        matches = rng.random((20_000, near_dedup.BANDS * near_dedup.ROWS)) < similarity
        kept = np.ones(20_000, bool)
        for n, least in near_dedup.fewest_matches(75, 1e-3):
            kept &= matches[:, :n].sum(axis=1) >= least
        assert kept.mean() > 0.97 if similarity == 0.75 else kept.mean() > 0.999
    far, alive = rng.random((20_000, 215)) < 0.4, np.ones(20_000, bool)
    left = []
    for n, least in near_dedup.fewest_matches(75, 1e-6):
        alive &= far[:, :n].sum(axis=1) >= least
        left.append(alive.mean())
    assert left == sorted(left, reverse=True) and left[0] < 0.6 and left[-1] < 1e-3


def test_signatures_estimate_similarity():
    shingler, rng = near_dedup.Shingler(), random.Random(7)
    words = [b"w%d" % rng.randrange(10**6) for _ in range(1200)]
    a, b = shingler(words[:900]), shingler(words[300:])
    exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = (near_dedup.signature(a) == near_dedup.signature(b)).mean()
    assert same == pytest.approx(exact, abs=0.12)


def test_components_of_a_chain(spark, stages):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "u bigint, v bigint")
    got = {r.node: r.component for r in near_dedup.components(edges, stages, "x").collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_labels_of_earlier_links_are_extended(spark, stages):
    rng, labels, links = random.Random(3), None, []
    for k in range(5):
        new = [tuple(sorted(rng.sample(range(90), 2))) for _ in range(12)] + links[:2]
        links += new
        labels = near_dedup.extended(labels, spark.createDataFrame(new, "u bigint, v bigint"), stages, f"e{k}")
        root = {i: i for edge in links for i in edge}
        for _ in root:
            for u, v in links:
                root[u] = root[v] = min(root[u], root[v])
        assert sorted(map(tuple, labels.collect())) == sorted(root.items())


def test_earlier_links_are_not_gone_through_again(spark, stages, monkeypatch):
    """A star of 500 classes that later meets one more class, and a link twice."""
    sizes, plain = [], near_dedup.components
    monkeypatch.setattr(
        near_dedup, "components", lambda edges, *more: sizes.append(edges.count()) or plain(edges, *more)
    )
    star = spark.range(1, 501).selectExpr("0L AS u", "id AS v")
    labels = near_dedup.extended(None, star, stages, "a")
    more = spark.createDataFrame([(7, 900), (8, 900), (3, 4)], "u bigint, v bigint")
    labels = near_dedup.extended(labels, more, stages, "b")
    assert sizes == [500, 1]
    assert {r.component for r in labels.collect()} == {0} and labels.count() == 502


# --- Pipeline ---------------------------------------------------------------------------------


def test_pipeline_against_each_stage_by_itself(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    stages, kept = Stages(spark, str(tmp_path)), docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in kept.select("doc_id", "text").collect()}
        kept = stages.write(name, stage(spark, kept, SF))
        after = {r.doc_id: r.text for r in kept.select("doc_id", "text").collect()}
        assert after.items() <= before.items() and len(after) == kept.count()
        if name != "shards":
            assert kept.columns == docs.columns
        if name == "language":
            assert set(before) - set(after) <= {i for i, t in before.items() if len(t or "") < 100}
        if name == "near_duplicates":
            assert set(after) == {i for i, (_, c) in brute_force(before).items() if i == c}
        if name == "decontamination":
            leaks = {i for i, t in before.items() if any(b in t for b in bench.values())}
            assert leaks and set(after) == set(before) - leaks
        if name == "mixture":
            assert 0 < len(after) < len(before)
        if name == "shards":
            assert set(after) == set(before)
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(after)


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0

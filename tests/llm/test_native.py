"""Line dedup, sharding, mixing and decontamination."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from conftest import TESTDATA
from hard_cases import docs, fresh, hard, nothing  # noqa: F401
from pyspark.sql import functions as F

from traitvote.llm import decontaminate as leaks
from traitvote.llm import line_dedup, mixing, sharding
from traitvote.llm.common import ROW_KEY

SF = str(TESTDATA / "sf0.001")


def python_free(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


# --- Line dedup ------------------------------------------------------------------


def test_lines_of_many_documents_go(docs, stages):
    table = docs((1, "a\n Share \nb"), (2, "SHARE\nc"), (3, "share"), (4, "share x\n\n"))
    found = line_dedup.dedup_lines(table, stages, min_docs=3)
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in found.collect()}
    assert got == {1: ("a\nb", 3, 1), 2: ("c", 2, 1), 3: ("", 1, 1), 4: ("share x\n\n", 3, 0)}
    assert python_free(found)


def test_a_line_repeated_in_one_document_counts_once(docs, stages):
    found = line_dedup.dedup_lines(docs((1, "x\nx\nx"), (2, "x")), stages, min_docs=3)
    assert {r.n_dropped for r in found.collect()} == {0}


def test_blank_keys_stay_unless_asked_for(docs, stages):
    table = docs((1, "\na"), (2, " \nb"))
    kept = line_dedup.dedup_lines(table, stages, min_docs=2).collect()
    assert sorted(r.text for r in kept) == ["\na", " \nb"]


def test_line_dedup_hard_cases(hard, nothing, stages):
    found = line_dedup.dedup_lines(hard(), stages, min_docs=2)
    rows = found.collect()
    assert len(rows) == 8 and [r.text for r in rows if r.doc_id == 4] == ["", ""]
    assert set(found.columns) == set(hard().columns) | {"n_dropped"}
    assert [r.text for r in rows if r.doc_id == 1] == [""]
    assert line_dedup.dedup_lines(nothing, fresh(stages)).count() == 0


# --- Sharding ----------------------------------------------------------------------


def sizes_of(rows):
    sizes = Counter()
    for row in rows:
        sizes[row.shard] += row.n_bytes
    return sizes


def test_shards_fit_and_are_not_split_without_need(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.shard(docs, stages, 40_000).collect()
    assert len(rows) == docs.count()
    sizes = sizes_of(rows)
    assert max(sizes.values()) <= 40_000
    together = Counter()
    for shard, size in sizes.items():
        for depth in range(len(shard)):
            together[shard[:depth]] += size
    assert min(together.values()) > 40_000  # every parent had to be split
    assert not any(a != b and b.startswith(a) for a in sizes for b in sizes)


def test_one_small_shard(docs, stages):
    rows = sharding.shard(docs((1, "ab"), (2, "é")), stages, 100).collect()
    assert [(r.shard, r.shard_depth, r.n_bytes) for r in rows] == [("", 0, 2), ("", 0, 2)]


def test_repeated_rows_over_the_limit_get_pages(docs, stages):
    rows = sharding.shard(docs(*[(7, "x" * 10)] * 50, (8, "y" * 10)), stages, 100).collect()
    assert len(rows) == 51
    sizes = sizes_of(rows)
    assert max(sizes.values()) <= 100 and len(sizes) > 5


def test_sharding_hard_cases(hard, nothing, stages):
    found = sharding.shard(hard(), stages, 50)
    assert found.count() == 8
    assert set(found.columns) == set(hard().columns) | {"shard_depth", "n_bytes"}
    assert sharding.shard(nothing, fresh(stages)).count() == 0


# --- Mixing ---------------------------------------------------------------------------


def cells(table, *rows):
    return table("a string, b string, tokens bigint", *rows)


def test_marginals_meet_their_targets(table, stages):
    rows = [(a, b, 10 + 7 * i + 3 * j) for i, a in enumerate("xyz") for j, b in enumerate("pq")]
    targets = {
        "a": table("value string, target double", ("x", 1.0), ("y", 2.0), ("z", 1.0)),
        "b": table("value string, target double", ("p", 3.0), ("q", 1.0), ("none", 9.0)),
    }
    raked = mixing.rake(cells(table, *rows), targets, stages).collect()
    sums = defaultdict(float)
    for r in raked:
        sums[r.a] += r.weight
        sums[r.b] += r.weight
    wanted = {"x": 0.25, "y": 0.5, "z": 0.25, "p": 0.75, "q": 0.25}
    assert sums == pytest.approx(wanted, abs=1e-6)


def two_targets(table, *of_b):
    even = table("value string, target double", ("x", 1.0), ("y", 1.0))
    return {"a": even, "b": table("value string, target double", *of_b)}


def test_marginals_of_dimensions_that_go_together_meet_their_targets(table, stages):
    rows = [("x", "p", 1000), ("x", "q", 150), ("y", "p", 150), ("y", "q", 1000)]
    targets = two_targets(table, ("p", 0.6), ("q", 0.4))
    sums = defaultdict(float)
    for r in mixing.rake(cells(table, *rows), targets, stages).collect():
        sums[r.a] += r.weight
        sums[r.b] += r.weight
    assert sums == pytest.approx({"x": 0.5, "y": 0.5, "p": 0.6, "q": 0.4}, rel=1e-6)


def test_targets_that_contradict_each_other_settle(table, stages, monkeypatch):
    rows = cells(table, ("x", "p", 10), ("y", "q", 10))
    targets = two_targets(table, ("p", 0.75), ("q", 0.25))
    for most in (mixing.FOLD_CELLS, 0):  # the last dimension's targets are met
        monkeypatch.setattr(mixing, "FOLD_CELLS", most)
        with pytest.warns(UserWarning, match="cannot be met"):
            raked = mixing.rake(rows, targets, fresh(stages)).collect()
        assert {r.a: r.weight for r in raked} == pytest.approx({"x": 0.75, "y": 0.25})


def jobs_of(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    result = action()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("other", "other")
    return result, len(jobs)


def test_many_rounds_are_few_jobs(spark, table, stages, monkeypatch):
    rng = random.Random(3)  # each source is almost all in one language
    rows = [
        (f"s{i}", f"l{j}", rng.randrange(1, 9) * (1000 if i % 4 == j else 1))
        for i in range(20) for j in range(4)
    ]
    even = [(f"s{i}", float(i + 1)) for i in range(20)], [(f"l{j}", float(j + 1)) for j in range(4)]
    targets = {n: table("value string, target double", *t) for n, t in zip("ab", even, strict=True)}
    got, jobs = jobs_of(spark, "fold", lambda: mixing.rake(cells(table, *rows), targets, stages).collect())
    assert jobs < 60
    by_a, by_b = defaultdict(float), defaultdict(float)
    for r in got:
        by_a[r.a] += r.weight
        by_b[r.b] += r.weight
    assert by_a == pytest.approx({f"s{i}": (i + 1) / 210 for i in range(20)}, rel=1e-6)
    assert by_b == pytest.approx({f"l{j}": (j + 1) / 10 for j in range(4)}, rel=1e-6)
    monkeypatch.setattr(mixing, "FOLD_ROUNDS", 3)  # a run in several jobs goes on where it stopped
    few = cells(table, *((a, b, n % 10 + 5) for a, b, n in rows[:8]))
    again = mixing.rake(few, targets, fresh(stages), 1e-4).collect()
    monkeypatch.setattr(mixing, "FOLD_CELLS", 0)  # nor do tables that Spark joins change anything
    tables = mixing.rake(few, targets, fresh(stages), 1e-4).collect()
    whole = {(r.a, r.b): r.weight for r in again}
    assert {(r.a, r.b): r.weight for r in tables} == pytest.approx(whole, rel=1e-6)


def test_many_capped_cells_meet_the_budget(table, stages):
    rows = [(f"v{k:03}", "b", 1000) for k in range(200)]
    weights = {f"v{k:03}": 0.8**k for k in range(200)}
    given = cells(table, *rows).join(table("a string, weight double", *weights.items()), "a")
    found = mixing.calibrate(given, 0.9 * 200_000, stages).collect()
    assert sum(r.probability * r.tokens for r in found) == pytest.approx(0.9 * 200_000)
    loose = [r.probability / r.weight for r in found if r.probability < 1]
    assert loose and loose == pytest.approx([loose[0]] * len(loose))
    assert all(r.probability == 1 for r in mixing.calibrate(given, 1e9, fresh(stages)).collect())


def test_probabilities_meet_the_budget(table, stages):
    rows = table(
        "a string, tokens bigint, weight double", ("x", 100, 0.9), ("y", 1000, 0.05), ("z", 500, 0.05)
    )
    found = {r.a: r for r in mixing.calibrate(rows, 400.0, stages).collect()}
    assert found["x"].probability == 1.0
    assert sum(r.probability * r.tokens for r in found.values()) == pytest.approx(400)


def test_mixing_hard_cases(hard, nothing, stages):

    by = {"source": F.col("source"), "topic": mixing.topic_of("text")}
    found = mixing.mix(hard(), by, stages)
    rows = found.collect()
    assert len(rows) == 8 and all(0 <= r.probability <= 1 for r in rows)
    assert len({r.kept for r in rows if r.doc_id == 4}) == 1
    assert python_free(found)
    assert mixing.mix(nothing, by, fresh(stages)).count() == 0


def test_budget_is_kept_on_real_documents(spark, stages):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    by = {"source": F.col("source"), "lang": F.col("lang")}
    rows = mixing.mix(docs, by, stages, keep=0.5).collect()
    total = sum(r.n_tokens for r in rows)
    assert sum(r.n_tokens * r.probability for r in rows) == pytest.approx(total / 2, rel=1e-3)
    assert sum(r.n_tokens for r in rows if r.kept) == pytest.approx(total / 2, rel=0.15)


# --- Decontamination --------------------------------------------------------------------


def invent(rng, n):
    return [f"w{rng.randrange(2000)}" for _ in range(n)]


def test_planted_items_are_found(table, stages):
    rng = random.Random(1)
    items = [invent(rng, rng.randint(15, 60)) for _ in range(20)]
    rows, wanted = [], set()
    for k, item in enumerate(items):
        edited = list(item)
        edited[len(item) // 2] = "changed"  # one word spoils five shingles
        rows.append((k, " ".join(invent(rng, 40) + item + invent(rng, 40))))
        wanted.add((k, k))
        rows.append((100 + k, " ".join(invent(rng, 30) + edited + invent(rng, 300))))
        # similarity (n - 5) / (n + 5) of n shingles
        n = len(item) - 4
        if 100 * (n - 5) >= 75 * (n + 5):
            wanted.add((100 + k, k))
        rows.append((200 + k, " ".join(invent(rng, 100) + item[: len(item) // 2])))
    docs = table("doc_id bigint, text string", *rows)
    bench = table("item_id bigint, text string", *((k, " ".join(i)) for k, i in enumerate(items)))
    found = leaks.find_items(docs, bench, stages)
    assert {(r[ROW_KEY[0]], r.item_id) for r in found.collect()} == wanted
    assert python_free(found)
    kept = leaks.decontaminate(docs, found).collect()
    assert {r.doc_id for r in kept} == {d for d, _ in rows} - {d for d, _ in wanted}


def test_blocks_cover_every_pair_within_the_radius(spark):
    rng = random.Random(2)
    pairs = []
    for _ in range(200):
        a = rng.getrandbits(60)
        b = a
        for bit in rng.sample(range(60), leaks.RADIUS):
            b ^= 1 << bit
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    overlap = F.arrays_overlap(leaks.blocks("a", leaks.RADIUS), leaks.blocks("b", leaks.RADIUS))
    assert df.filter(~overlap).count() == 0


def test_simhash_counts_bits(spark):
    rng = random.Random(3)
    rows = [([rng.getrandbits(63) for _ in range(n)],) for n in (1, 2, 3, 50, 400)]
    df = spark.createDataFrame(rows, "hs array<bigint>")
    for hs, fp in df.select("hs", leaks.simhash(F.col("hs")).alias("fp")).collect():
        wanted = sum(1 << b for b in range(60) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
        assert fp == wanted


def test_weights_count_repeats(spark):
    df = spark.createDataFrame([([1, 1, 2, 3], [1, 1, 1, 3, 4]), ([1, 1], [1])], "a array<bigint>, b array<bigint>")
    assert [r[0] for r in df.select(leaks.common_weight("a", "b")).collect()] == [3, 1]


def test_decontamination_hard_cases(hard, nothing, table, stages):

    bench = table("item_id bigint, text string", (1, "No ID at all"), (2, None), (3, ""), (None, "one"))
    found = leaks.find_items(hard(), bench, stages)
    assert {(r[ROW_KEY[0]], r.item_id) for r in found.collect()} == {(None, 1), (4, None)}
    kept = leaks.decontaminate(hard(), found)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 2, 3, 5, None]
    again = fresh(stages)
    assert leaks.find_items(nothing, bench, again).count() == 0
    assert leaks.find_items(hard(), bench.limit(0), fresh(stages)).count() == 0


def best_windows(docs, items, percent=75):
    """Similarity of the best of all windows of each item's size, by brute force."""

    def runs(words):
        return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]

    found = {}
    for d, words in docs:
        hs = runs(words)
        for k, item in items:
            own = Counter(runs(item))
            m = sum(own.values())
            for start in range(max(1, len(hs) - m + 1)):
                window = Counter(hs[start : start + m])
                common = sum((window & own).values())
                union = sum(window.values()) + m - common
                if 100 * common >= percent * union:
                    found[d, k] = max(found.get((d, k), 0.0), common / union)
    return found


def test_items_in_another_order_are_found(table, stages):
    rng = random.Random(4)
    items = [(k, invent(rng, 60)) for k in range(30)]
    docs = []
    for k, item in items:
        cut = 30 if k < 10 else rng.randrange(1, 60)  # halves swapped, or turned anywhere
        docs.append((k, invent(rng, 80) + item[cut:] + item[:cut] + invent(rng, 80)))
    wanted = best_windows(docs, items)
    assert {(k, k) for k in range(10)} <= set(wanted)
    found = leaks.find_items(
        table("doc_id bigint, text string", *((d, " ".join(w)) for d, w in docs)),
        table("item_id bigint, text string", *((k, " ".join(w)) for k, w in items)),
        stages,
    )
    got = {(r[ROW_KEY[0]], r.item_id): r.similarity for r in found.collect()}
    assert got == pytest.approx(wanted)
    assert python_free(found)


def test_only_items_with_shared_shingles_are_candidates(spark, table, stages):
    rng = random.Random(5)
    items = [" ".join(invent(rng, 40)) for _ in range(40)]  # one size, so one key before
    words = [" ".join(invent(rng, 20)) for _ in items]
    docs = table("doc_id bigint, text string", *((k, f"{w} {i}") for k, (w, i) in enumerate(zip(words, items))))
    found = leaks.find_items(docs, table("item_id bigint, text string", *enumerate(items)), stages)
    assert {(r[ROW_KEY[0]], r.item_id) for r in found.collect()} == {(k, k) for k in range(40)}
    candidates = spark.read.parquet(f"{stages.path}/candidates")
    assert candidates.filter(f"{ROW_KEY[0]}_near != item_id").count() == 0


def test_a_line_that_all_items_share_pairs_nothing(spark, table, stages):
    """1,000 items and 200 documents begin alike; 20 documents hold an item."""
    rng = random.Random(6)
    opening = [f"instruction{k}" for k in range(9)]
    items = [(k, opening + invent(rng, 45)) for k in range(1_000)]
    docs = [(k, opening + invent(rng, 60) + (items[k * 5][1] if k % 10 == 0 else [])) for k in range(200)]
    found = leaks.find_items(
        table("doc_id bigint, text string", *((d, " ".join(w)) for d, w in docs)),
        table("item_id bigint, text string", *((k, " ".join(w)) for k, w in items)),
        stages,
    )
    got = {(r[ROW_KEY[0]], r.item_id): r.similarity for r in found.collect()}
    assert got == {(k, k * 5): 1.0 for k in range(0, 200, 10)}
    # the opening alone would make 200,000 pairs
    assert spark.read.parquet(f"{stages.path}/paired").count() < 500
    assert spark.read.parquet(f"{stages.path}/hits").count() < 5_000


def test_rare_shingles_of_an_item_that_documents_hold_in_part(table, stages):
    """Items of common shingles, repeated shingles, and windows cut short by the end."""
    rng = random.Random(7)
    common = invent(rng, 30)
    items = [(0, common), (1, common[:20] + invent(rng, 6)), (2, ["a", "b", "c", "d", "e"] * 8), (3, invent(rng, 24))]
    docs = [(k, invent(rng, 5) + common + invent(rng, k)) for k in range(12)]
    docs += [(20, items[3][1][:22]), (21, items[3][1][4:]), (22, ["a", "b", "c", "d", "e"] * 7), (23, items[1][1])]
    wanted = best_windows(docs, items)
    found = leaks.find_items(
        table("doc_id bigint, text string", *((d, " ".join(w)) for d, w in docs)),
        table("item_id bigint, text string", *((k, " ".join(w)) for k, w in items)),
        stages,
    )
    got = {(r[ROW_KEY[0]], r.item_id): r.similarity for r in found.collect()}
    assert got == pytest.approx(wanted) and {(20, 3), (21, 3), (22, 2), (23, 1)} <= set(got)

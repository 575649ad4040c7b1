"""Merkle manifest, SimHash near duplicates, lexical search."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
import xxhash
from conftest import TESTDATA
from hard_cases import docs, fresh, hard, nothing  # noqa: F401
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitvote.llm import lexical_search, merkle, simhash
from traitvote.llm.common import ROW_KEY
from traitvote.llm.queries import QUERIES

SF = str(TESTDATA / "sf0.001")

DOCUMENTS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


# --- Merkle manifest -------------------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def siblings(levels, at):
    """(side, siblings) of each level from ``at`` up."""
    for level in levels[:-1]:
        run = at - at % 2
        yield at % 2, [d for k, d in enumerate(level[run : run + 2], run) if k != at]
        at //= 2


def manifest(rows):
    """The rows of the query by plain Python; ``rows`` are in the order of the leaf."""
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)
    langs = sorted(by_lang, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = []
    for lang in langs:
        own = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((own, levels_of([leaf_of(r) for r in own])))
    top = levels_of([levels[-1][0] for _, levels in trees])
    root, out = top[-1][0], []
    for t, (own, levels) in enumerate(trees):
        for k, row in enumerate(own):
            way = [*siblings(levels, k), *siblings(top, t)]
            tampered = row
            if row[0] is not None and crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                tampered = (*row[:3], row[3] + 1, row[4])
            folded = leaf_of(tampered)
            for side, other in way:
                folded = h(*other, folded) if side else h(folded, *other)
            proof = h(*(d for _, other in way for d in other))
            out.append((row[0], leaf_of(row), levels[-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def queried(df, stages):
    rows = merkle.verified(merkle.manifest(df, stages))
    proof = merkle.proof_digest(F.concat("segment", "top_segment"))
    hexed = [F.lower(F.hex(c)) for c in ("leaf", "subroot", "root")]
    found = rows.select("doc_id", *hexed, proof, F.lower(F.hex("folded")), F.expr("folded = root"))
    return sorted((tuple(r) for r in found.collect()), key=repr)


def some_rows(sizes, seed=1):
    rng, rows = random.Random(seed), []
    for lang, n in sizes.items():
        for _ in range(n):
            i = rng.randrange(10**6)
            rows.append((i, rng.choice(["web", None, "ü"]), lang, rng.choice([None, 5, 10**12]), f"té {i}"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 2, None: 1}, {"en": 700, "de": 257, None: 3, "": 1, "é": 256}])
def test_manifest_against_plain_python(table, stages, sizes):
    rows = some_rows(sizes)
    rows += rows[:2]  # repeated rows are leaves of their own
    got = queried(table(DOCUMENTS, *rows), stages)
    assert got == manifest(rows)
    assert any(not r[-1] for r in got) or len(rows) < 10


def test_many_small_groups_and_higher_jumps(table, stages, monkeypatch):
    monkeypatch.setattr(merkle, "SPAN", 1)  # more passes, and jumps above it from the third on
    monkeypatch.setattr(merkle, "SPREAD", 2)
    monkeypatch.setattr(merkle, "BROADCAST_GROUPS", 3)
    rows = some_rows({f"l{k}": 1 + k % 4 for k in range(40)} | {"hot": 150}, seed=2)
    assert queried(table(DOCUMENTS, *rows), stages) == manifest(rows)


def test_manifest_hard_cases(spark, hard, nothing, stages):
    def whole(df):
        return df.withColumn("n_chars", F.length("text").cast("bigint"))

    df = whole(hard((7, "tie"), (7, "another")))
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]
    assert queried(df, stages) == manifest(rows)
    assert queried(whole(nothing), fresh(stages)) == []


def test_a_manifest_tells_any_change(table, stages):
    rows = some_rows({"en": 20, "de": 5}, seed=3)
    root = manifest(rows)[0][3]
    for k in (0, 7):
        for column, value in ((1, "other"), (3, 77), (4, "")):
            changed = list(rows)
            changed[k] = (*rows[k][:column], value, *rows[k][column + 1 :])
            assert manifest(changed)[0][3] != root


# --- SimHash -----------------------------------------------------------------------------


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    runs = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum((2 * sum(x >> b & 1 for x in hashes) > len(hashes)) << b for b in range(64))


def components_of(prints):
    """Smallest id reachable, over all pairs; ``prints`` are (id, fingerprint)."""
    values, parent = np.array([f for _, f in prints], np.uint64), list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1 :]) <= 4):
            parent[root(i)] = root(i + 1 + int(j))
    groups = defaultdict(list)
    for k in range(len(prints)):
        groups[root(k)].append(prints[k][0])
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return [least[root(k)] for k in range(len(prints))]


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_fingerprints_against_plain_python():
    rng = random.Random(4)
    texts = [None, "", " \t\n", "a", "A b", "a b c", "A b C d", "a b c d e", "ÄÖ é a\x0bb c\x1fd e\x00f g h"]
    texts += [" ".join(rng.choice("ab cd ef gh".split()) for _ in range(n)) for n in (7, 90, 9_001)]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_two_fingerprints_within_the_radius_share_a_variant(spark):
    rng, pairs = random.Random(5), []
    for k in range(4_000):
        a = rng.getrandbits(64)
        flips = rng.sample(range(64), 1 + k % 4)
        if k % 2:  # all in few segments
            start = rng.randrange(60)
            flips = list(range(start, start + 1 + k % 4))
        b = a
        for bit in flips:
            b ^= 1 << bit
        pairs.append((signed(a), signed(b)))
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    found = df.select(
        F.arrays_overlap(simhash.variants(F.col("a")), simhash.variants(F.col("b"))).alias("met"),
        F.size(simhash.variants(F.col("a"))).alias("n"),
    ).collect()
    assert all(r.met and r.n == 64 for r in found)


@pytest.mark.parametrize("portion", [4096, 3])
def test_links_against_all_pairs(spark, stages, monkeypatch, portion):
    """A dense group, chains, and nodes of one bucket that are no links."""
    monkeypatch.setattr(simhash, "PORTION", portion)
    rng, values = random.Random(6), {0}
    centre = rng.getrandbits(64)
    for _ in range(300):
        v = centre
        for bit in rng.sample(range(64), rng.randrange(1, 6)):
            v ^= 1 << bit
        values.add(v)
    for _ in range(40):  # chains: each is near the one before only
        v = rng.getrandbits(64)
        for _ in range(5):
            values.add(v)
            for bit in rng.sample(range(64), 4):
                v ^= 1 << bit
    low = rng.getrandbits(21)  # equal in a segment, else random
    values |= {low | rng.getrandbits(43) << 21 for _ in range(150)}
    rows = [(signed(v),) for v in sorted(values)]
    got = {r.node: r.component for r in simhash.link(spark.createDataFrame(rows, "node bigint"), stages).collect()}
    ids = [(v, v & (2**64 - 1)) for (v,) in rows]
    wanted = dict(zip((v for v, _ in ids), components_of(ids), strict=True))
    assert got == wanted


def test_simhash_hard_cases(hard, nothing, stages):
    extra = ((9, "NO id AT all"), (10, "ONE"), (11, "w " * 5), (12, "W " * 50))
    rows = simhash.near_duplicates(hard(*extra), stages).collect()
    given = [(r[ROW_KEY[0]], r.fingerprint & (2**64 - 1)) for r in rows]
    assert len(rows) == 8 + len(extra)
    assert Counter(r.component_id for r in rows) == Counter(components_of(given))
    assert {r.component_id for r in rows if r.fingerprint == 0} == {1}  # no words: linked with each other
    assert [r.component_id for r in rows if r[ROW_KEY[0]] == 4] == [4, 4]
    assert simhash.near_duplicates(nothing, fresh(stages)).count() == 0


def test_simhash_query_against_all_pairs(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = [(i, plain_fingerprint(t)) for i, t in texts.items()]
    wanted = sorted((i, f"{f:016x}", c) for (i, f), c in zip(prints, components_of(prints), strict=True))
    got = QUERIES["op12_simhash_dedup"](spark, SF)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()) == wanted


# --- Lexical search ------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(texts, items, limit=10):
    counts = [(i, Counter(terms_of(t))) for i, t in texts]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_all = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_all
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(terms_of(text)) if c[t]
            )
            if score > 0:
                scores.append((-score, i is None, i))
        out += [
            (item, rank, i, -negative)
            for rank, (negative, _, i) in enumerate(sorted(scores, key=lambda s: (*s[:2], s[2] or 0))[:limit], 1)
        ]
    return sorted(out, key=repr)


def some_texts(n, seed):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    return [(rng.choice([i, i // 2]), " ".join(rng.choices(words, k=rng.choice([1, 5, 40, 300])))) for i in range(n)]


def test_terms_in_pieces(monkeypatch):
    monkeypatch.setattr(lexical_search, "CHUNK", 7)
    texts = [None, "", "-- !", "A1-b_C\x7fü€x9", "aa  BB cc " * 30, "unbroken" * 20]
    for text in texts:
        got = [t.decode() for piece in lexical_search.pieces(text) for t in piece]
        assert got == terms_of(text)


@pytest.mark.parametrize("small", [False, True])
def test_search_against_all_documents(docs, table, stages, monkeypatch, small):
    if small:  # several blocks, batches of few rows, merges of many heaps
        monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", 60)
        monkeypatch.setattr(lexical_search, "SCORES", 40)
    texts = some_texts(300, 7)
    items = some_texts(25, 8) + [(100, "w1 w1"), (100, "w1"), (None, "w2 w3"), (101, None), (102, "??"), (103, "none")]
    df = docs(*texts).repartition(13)
    got = lexical_search.search(df, table("item_id bigint, text string", *items), stages)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == ranked(texts, items)


def test_heaps_keep_the_best():
    rng = np.random.default_rng(9)
    heaps, all_rows = lexical_search.Heaps(5, 4), []
    for _ in range(30):
        item, score = rng.integers(0, 5, 20), rng.integers(1, 8, 20)
        doc, no_id = rng.integers(0, 50, 20), rng.random(20) < 0.1
        heaps.add(item, score, doc, no_id)
        all_rows += zip(item.tolist(), (-score).tolist(), no_id.tolist(), doc.tolist(), strict=True)
    wanted = [r for k in range(5) for r in sorted(r for r in all_rows if r[0] == k)[:4]]
    assert list(zip(heaps.item, -heaps.score, heaps.no_id, heaps.doc, strict=True)) == wanted


def test_search_hard_cases(hard, nothing, stages, table):
    items = table("item_id bigint, text string, doc_id string, score int", (1, "word id", "x", 1), (2, None, "y", 2))
    texts = [(r.doc_id, r.text) for r in hard().collect()]
    got = lexical_search.search(hard(), items, stages)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == ranked(texts, [(1, "word id"), (2, None)])
    assert lexical_search.search(nothing, items, fresh(stages)).count() == 0
    empty = lexical_search.search(hard(), items.limit(0), fresh(stages))
    assert empty.count() == 0 and dict(empty.dtypes) == dict(got.dtypes)
    assert [f.dataType for f in got.schema][1] == T.IntegerType()

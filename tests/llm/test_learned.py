"""Language ID, HTML extraction, quality rules and classifier, license scan."""

from __future__ import annotations

import random
import re
import string
import time
from itertools import product

import numpy as np
import pytest
from conftest import TESTDATA
from hard_cases import docs, fresh, hard, nothing  # noqa: F401
from pyspark.sql import functions as F

from traitvote.llm import QUERIES, html_extract, language_id, license_scan, quality_gam, quality_rules
from traitvote.llm.html_blocks import blocks_of, features_of
from traitvote.llm.labelled import bounded_sample, labelled_texts, quality_labels
from traitvote.llm.text_stats import Words, covered_by_repeats, repeated_lines, word_chars

SF = str(TESTDATA / "sf0.01")


# --- Language ID -------------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark):
    return language_id.fitted_for(spark, SF)


def test_held_out_documents_are_told(spark):
    got = QUERIES["op4_language_id"](spark, SF)
    langs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = got.join(langs, "doc_id").filter("held_out").collect()
    assert len(held) > 150
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98


def test_mixtures_are_inferred(spark, model):
    rows = spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars > 3000").collect()
    by = {r.lang: r.text for r in rows}
    mixed = by["de"][:1000] + " " + by["es"][:2000]
    found = language_id.infer(model, mixed)
    assert set(found) == {"de", "es"}
    assert found["es"] == pytest.approx(2 / 3, abs=0.08)
    assert sum(found.values()) == pytest.approx(1, abs=1e-6)
    assert list(language_id.infer(model, by["fr"])) == ["fr"]


def test_expectation_maximisation_never_loses_likelihood(model):
    rng = np.random.default_rng(1)
    likelihood, counts = rng.random((3, 40)) ** 4 + 1e-4, rng.integers(1, 9, 40).astype(float)
    weights, best = language_id._mixture(likelihood, counts)
    for other in rng.dirichlet(np.ones(3), 200):
        assert counts @ np.log(other @ likelihood) <= best + 0.1
    assert weights.sum() == pytest.approx(1)


def test_language_hard_cases(hard, nothing, model):
    rows = language_id.identify(hard((8, "123 !?"), (9, "ß")), model).collect()
    got = {r.doc_id: r.lang_pred for r in rows}
    assert got[1] == got[2] == got[3] == got[8] == "und" and got[9] != "und"
    assert all(0 <= r.lang_score <= 1 for r in rows)
    assert language_id.identify(nothing, model).count() == 0
    empty = language_id.fit(nothing)
    assert empty.languages == ()
    assert {r.lang_pred for r in language_id.identify(hard(), empty).collect()} == {"und"}


# --- HTML extraction ----------------------------------------------------------------


@pytest.fixture(scope="module")
def field(spark):
    return html_extract.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def test_articles_of_the_pages_are_extracted(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for row in QUERIES["op5_html_extraction"](spark, SF).collect():
        article = re.search("<article>(.*?)</article>", pages[row.page_id], re.S)[1]
        parts = re.split("</?(?:p|h1|br)>", re.sub("</?b>", "", article))
        texts = [" ".join(html.unescape(part).split()) for part in parts]
        assert row.text == "\n".join(t for t in texts if t)
        assert row.n_chars == len(row.text)


def test_other_layouts(field):
    page = """<html><head><title>T</title></head><body><header><h1>Site</h1><p>A motto</p></header>
      <nav><a href=1>Home</a> <a href=2>About</a></nav>
      <div class="cookie-banner">We use cookies. <button>OK</button></div>
      <main><h1>A title</h1><p>First &lt;one&gt; with <a href=3>a link</a>   in it.</p>
      <div class="advert">Buy now</div><p>Second one,<br>in two lines.</p>
      <script>if (a < b) { x("</p>") }</script></main>
      <aside><p>Some words at the side that go on.</p></aside>
      <section id="comments"><h3>Comments</h3><p>I liked this a lot, thank you.</p></section>
      <form><label>Mail</label></form><footer>&copy; Us</footer>"""
    blocks = blocks_of(page)
    main = [b.text for b, y in zip(blocks, field.decode(blocks), strict=True) if y]
    assert main == ["A title", "First <one> with a link in it.", "Second one,", "in two lines."]


def test_made_pages_that_were_not_trained_on(field):
    rng, wrong, total = random.Random(5), 0, 0
    for _ in range(200):
        blocks, labels = html_extract.labelled_page(rng, ["Some words, of a text. " * 9] * 3)
        wrong += sum(a != b for a, b in zip(field.decode(blocks), labels, strict=True))
        total += len(labels)
    assert wrong / total < 0.03


def test_viterbi_finds_the_likeliest_chain(field):
    blocks, _ = html_extract.labelled_page(random.Random(6), ["a b c. " * 20])
    blocks = blocks[:9]
    own = [field.emission[[field.index[n] for n in f if n in field.index]].sum(0) for f in features_of(blocks)]

    def score(labels):
        pairs = zip(labels, labels[1:], strict=False)
        total = field.first[labels[0]] + sum(field.transition[a, b] for a, b in pairs)
        return total + sum(own[k][y] for k, y in enumerate(labels))

    best = max(product((0, 1), repeat=len(blocks)), key=score)
    assert score(field.decode(blocks)) == pytest.approx(score(best))


def test_a_head_ends_where_the_body_begins():
    for page in (
        "<head><title>t</title><body><article><p>Hello</p></article></body>",
        "<head><title>t</title><meta charset=utf-8><article><p>Hello</p></article>",
        "<head><title>t<body><p>Hello</p>",
        "<head><title>t</title><img src=x/><p>Hello</p>",
        "<head><title>t</title>Hello",
        "<head><noscript><style>x</style></noscript><template><p>no</p></template><body><p>Hello</p>",
        "<head><title>t</title></head><body><p>Hello</p></body>",
    ):
        assert [block.text for block in blocks_of(page)] == ["Hello"], page


def test_html_hard_cases(spark, field):
    given = [
        (1, "u", None, "x"), (2, None, "", "x"), (2, None, "", "x"), (None, "u", "<<<p>&am", "x"),
        (4, "u", "<article><p>" + "word " * 50_000, "x"), (5, "u", "<nav><p>x", "x"),
    ]
    table = spark.createDataFrame(given, "page_id bigint, url string, html string, text string")
    rows = html_extract.extract(table, field).collect()
    assert len(rows) == 6
    got = {r.page_id: r.text for r in rows}
    assert got[1] == got[2] == got[5] == "" and len(got[4]) == 249_999
    assert html_extract.extract(table.limit(0), field).count() == 0
    assert html_extract.fit(table.limit(0), made=5).decode([]) == []


# --- Quality ---------------------------------------------------------------------------

WORD = re.compile("[^\x20\x09-\x0d]+")


def test_counts_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op6_quality_rules"](spark, SF).collect():
        text = texts[r.doc_id] or ""
        words = WORD.findall(text)
        seen, runs = set(), {}
        for k in range(len(words) - 2):
            runs.setdefault(tuple(words[k : k + 3]), []).append(k)
        covered = {k + i for ks in runs.values() if len(ks) > 1 for k in ks for i in range(3)}
        lines, repeated = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                repeated += line in lines
                lines.add(line)
        symbols = sum(c in "#*$%&|<>" for c in text)
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), symbols, repeated, len(covered), failed,
        )
        assert not (failed and r.kept) and seen == set()


def accuracy(spark, query, column, where):
    labels = quality_labels(spark.read.parquet(f"{SF}/labels.parquet"))
    rows = QUERIES[query](spark, SF).drop("quality").join(labels, "doc_id").filter(where).collect()
    return sum(bool(r[column]) == bool(r.quality) for r in rows) / len(rows), len(rows)


def test_good_documents_are_kept(spark):
    share, n = accuracy(spark, "op6_quality_rules", "kept", "NOT base_failed")
    assert n > 200 and share > 0.97


def test_classifier_on_held_out_labels(spark):
    share, n = accuracy(spark, "op8_quality_classifier", "predicted", "held_out")
    assert n > 50 and share > 0.95


def test_probabilities_are_calibrated():
    rng = np.random.default_rng(2)
    z = rng.normal(size=4000) * 3
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.7 * z - 0.4)))).astype(float)
    slope, offset = quality_rules._calibrate(z, y)
    assert (slope, offset) == pytest.approx((0.7, -0.4), abs=0.1)


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.boost(x, y)
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.95
    assert model.pairs[0][:2] == (0, 1)


def test_quality_hard_cases(hard, nothing, docs, table):
    labels = table("doc_id bigint, quality int", (5, 1), (5, 1), (4, 0), (None, 1), (6, None))
    for fit, use in (
        (quality_rules.fit, quality_rules.judge),
        (quality_gam.fit, lambda d, m: quality_gam.score(d, m)),
    ):
        some = hard((7, "A text that is good enough. " * 20))
        model = fit(some.dropDuplicates(["doc_id"]), labels)
        rows = use(some, model).collect()
        assert len(rows) == 9
        assert use(nothing, model).count() == 0
        without = fit(some, labels.limit(0))
        assert len(use(some, without).collect()) == 9


def test_samples_are_bounded(spark):
    rows = spark.range(5000).withColumnRenamed("id", "doc_id")
    assert bounded_sample(rows, 100, "doc_id").count() == 100
    assert bounded_sample(rows, 9000, "doc_id").count() == 5000


def test_small_text_counts():
    words = Words()

    def covered(text):
        return covered_by_repeats(words.hashes(words.split(text)))

    assert covered("a b c a b c") == 6 and covered("a b c d a b c") == 6 and covered("a a a") == 0
    assert covered("a a a a") == 4 and covered("") == 0
    assert repeated_lines("a\n\n \na\nb\na") == 2 and word_chars(" é b\n") == 2


# --- License scan -------------------------------------------------------------------------


def test_blocks_against_brute_force():
    rng = random.Random(8)
    templates = (
        license_scan.Template("x", "the quick brown fox jumps over the lazy dog", 70),
        license_scan.Template("y", "quick fox", phrase=True),
        license_scan.Template("z", "a b c d", 50),
    )
    vocabulary = "the quick brown fox jumps over lazy dog a b c d".split() + list(string.ascii_lowercase)
    frequency = {w.encode(): rng.randrange(100) for w in vocabulary}
    scanner = license_scan.Scanner(templates, frequency)
    for _ in range(300):
        words = [rng.choice(vocabulary).encode() for _ in range(rng.randrange(0, 40))]
        wanted = set()
        for number, one in enumerate(templates):
            parts = one.text.encode().split()
            width = min(len(parts), len(words))
            for start in range(len(words) - width + 1 if words else 0):
                block = words[start : start + width]
                common = len(set(block) & set(parts))
                if common * 100 >= one.percent * len(set(parts)) and (not one.phrase or block == parts):
                    wanted.add((number, start))
        assert {(n, s) for n, s, _, _ in scanner.blocks(words)} == wanted


def test_each_license_filter_prunes_and_loses_nothing():
    templates = (
        license_scan.Template("mit", "mit license", phrase=True),
        license_scan.Template("x", "rare words of a notice that all may copy", 80),
        license_scan.Template("far", "nothing here has such tokens", 80),
    )
    frequency = {w: k for k, w in enumerate(b"rare mit words license notice of a".split())}
    scanner = license_scan.Scanner(templates, frequency)

    def counted(text, number):
        """Blocks left by the prefix, then also the length, then the positional filter."""
        words = license_scan.words_of(text)
        ids = np.array([scanner.rank.get(w, -1) for w in words])
        hits = scanner.hits(ids)
        if number not in hits:
            return 0, 0, 0
        one = scanner.templates[number]
        masks = scanner.filters(one, hits[number], ids, scanner.places(one, ids))
        return tuple(int(np.logical_and.reduce(masks[:k]).sum()) for k in (1, 2, 3))

    assert counted("mit x y mit mit of mit license", 0) == (6, 4, 1)  # mit mit, mit of, of mit, mit license
    assert counted("copy copy copy copy a a words words words of", 1) == (2, 2, 0)
    assert counted("so rare words of a notice that all may copy", 1) == (2, 2, 2)
    assert counted("mit license", 2) == (0, 0, 0)  # the index leads to other templates only


def test_license_hard_cases(hard, nothing):
    rows = license_scan.scan(hard((8, "MIT-License, and the mit\nlicense; all rights RESERVED"))).collect()
    found = next(r for r in rows if r.doc_id == 8)
    assert (found.n_words, found.n_base, found.first_word, found.last_word) == (9, 2, 0, 4)
    assert (found.base_labels, found.labels, found.score) == ("mit", "mit,proprietary", 1.0)
    none = next(r for r in rows if r.doc_id == 1)
    assert (none.n_words, none.n_base, none.first_word, none.labels, none.score) == (0, 0, None, "", 0.0)
    assert len(rows) == 9
    assert license_scan.scan(nothing).count() == 0


# --- Bounds of what is fitted on, and of what a page takes -----------------------------------


def test_an_id_with_very_many_rows_is_one_label(spark, table):
    many = spark.range(100_000).selectExpr("7 AS doc_id", "concat('text ', id % 3) AS text")
    others = table("doc_id bigint, text string", (1, "one"), (2, None), (3, "three"))
    labels = table("doc_id bigint, quality int, toxic int", (7, 1, 0), (1, 0, 0), (2, 1, 0), (9, 1, 0))
    found = labelled_texts(others.unionByName(many), labels, 10).collect()
    assert sorted((r.doc_id, r.quality) for r in found) == [(1, 0), (2, 1), (7, 1)]
    assert len({r.text for r in found if r.doc_id == 7}) == 1


def test_a_page_of_unclosed_elements_takes_time_in_proportion():
    def seconds(n):
        page = "<article>" + "".join(f"<div class=body>word {i}</b>" for i in range(n))
        start = time.perf_counter()
        blocks = blocks_of(page)
        features_of(blocks)
        assert html_extract.labels_of(blocks) == [1] * n
        return time.perf_counter() - start

    seconds(1_000)
    assert seconds(60_000) < 30


def test_text_that_stands_in_for_an_object_is_text():
    page = "<article><p>a</p><object><p>b</p></object><canvas>c</canvas><svg>d</svg></article>"
    assert [b.text for b in blocks_of(page)] == ["a", "b", "c"]

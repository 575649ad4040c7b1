"""Near duplicates by MinHash bands and sequential Bayesian verification.

One pass over the texts makes a key of each text's words, a MinHash signature
and its band keys. Texts with equal words are one class from there on. Classes
that share a band are candidates; a bucket's classes are compared with the
bucket's first class only, each class with one of these at a time, as long as
that links many: a group of near copies becomes one component by about one pair
a class. Where a bucket then still spans several components, the classes outside
its largest one are compared with all others; nearly all of these pairs that are
no links are ruled out by what either shares with the bucket's first class and by
marks of its further shingles. Two components are first linked by the pair that
promises most. Signatures are compared
batch by batch: after each batch a pair is given up if the posterior chance that
its similarity reaches the threshold is below the chosen miss probability.
Survivors are verified on the whole shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..sources import Stages
from .common import ROW_KEY, row_key

SHINGLE = 5
BANDS, ROWS = 43, 5
#: Chance of giving up a pair that reaches the threshold, for each batch.
MISS = 1e-6
#: Classes of a portion, where those outside a bucket's largest component are
#: compared with the others portion by portion.
OUTSIDE = 200
#: A bucket with more of them first meets further leaders, drawn from them, while
#: that links more than a small share; what is left is compared all the same.
LARGE = 500
FEW = 0.02
#: Classes meet one leader at a time until fewer than this share of them is linked.
FRUITFUL = 0.3
#: Classes whose rows are looked up by broadcast (some 50 bytes each); beyond
#: that the texts are shuffled.
BROADCAST_CLASSES = 300_000
#: Bytes of the marks of a class's further shingles: one for each shingle of its
#: leader, within these limits. Fewer marks rule out fewer pairs, but lose none.
MARK_BYTES = (8, 4_096)
#: Shingles hashed at a time, so that a long text needs no more memory.
CHUNK = 512
#: Words whose hashes a task remembers (some 150 bytes each).
CACHE_WORDS = 50_000
#: Texts signed at a time.
SIGNED_ROWS = 1_000

_RANDOM = np.random.default_rng(20_240_601)
_ODD = _RANDOM.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _RANDOM.integers(0, 2**63, (2, SHINGLE), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _scramble(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


class Shingler:
    """Sorted distinct 64-bit shingles of texts; remembers hashes of words."""

    def __init__(self) -> None:
        self._cache: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        cache = self._cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for word in words:
            if word not in cache:
                cache[word] = xxhash.xxh64_intdigest(word)
        hashes = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
        size = len(words)
        if size == 0:
            return hashes
        if size < SHINGLE:  # the whole sequence; its length is part of the hash
            mixed = (hashes * _MIX[1][:size]).sum(dtype=np.uint64, keepdims=True)
            return _scramble(mixed + np.uint64(size))
        runs = hashes[: size - SHINGLE + 1] * _MIX[0][0]
        for k in range(1, SHINGLE):
            runs += hashes[k : size - SHINGLE + 1 + k] * _MIX[0][k]
        return np.unique(_scramble(runs))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each permutation of the shingles."""
    least = np.full(len(_ODD), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), CHUNK):
        part = shingles[start : start + CHUNK]
        np.minimum(least, (_ODD[:, None] * part[None, :]).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; the same values in another band differ."""
    bands = least.reshape(BANDS, ROWS)
    keys = (_scramble(bands.copy()) * _MIX[1][:ROWS]).sum(axis=1, dtype=np.uint64)
    return _scramble(keys + np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[0][0]).view(np.int64)


SIGNED = (
    f"{ROW_KEY[0]} bigint, {ROW_KEY[1]} bigint, {ROW_KEY[2]} bigint, key_a bigint, key_b bigint, "
    "n_shingles bigint, bands array<bigint>, signature binary"
)


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shingler = Shingler()
    parts = (b.iloc[k : k + SIGNED_ROWS] for b in batches for k in range(0, len(b), SIGNED_ROWS))
    for batch in parts:
        rows = []
        for text in batch["__text"]:
            words = words_of(text)
            if not words:
                rows.append((None, None, 0, None, None))
                continue
            digest = xxhash.xxh3_128_digest(b" ".join(words))
            shingles = shingler(words)
            least = signature(shingles)
            rows.append(
                (
                    int.from_bytes(digest[:8], "little", signed=True),
                    int.from_bytes(digest[8:], "little", signed=True),
                    len(shingles),
                    band_keys(least),
                    _scramble(least).astype(np.uint8).tobytes(),
                )
            )
        columns = ["key_a", "key_b", "n_shingles", "bands", "signature"]
        made = pd.DataFrame(rows, columns=columns).astype({"key_a": "Int64", "key_b": "Int64"})
        yield pd.concat([batch.drop(columns="__text").reset_index(drop=True), made], axis=1)


def fewest_matches(percent: int, miss: float) -> list[tuple[int, int]]:
    """For each batch the values compared so far and the matches to go on.

    With an even prior the posterior after m of n matches is Beta(m+1, n-m+1),
    and P(similarity >= t) = P(Binomial(n+1, t) <= m).
    """
    t, out = percent / 100, []
    for n in range(BANDS, BANDS * ROWS + 1, BANDS):
        below, least = 0.0, 0
        for m in range(n + 1):
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= miss:
                least = m
                break
        out.append((n, least))
    return out


def _prune(percent: int, miss: float):
    batches_of = fewest_matches(percent, miss)

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            left, right = (
                np.frombuffer(b"".join(batch[c]), np.uint8).reshape(len(batch), -1)
                for c in ("signature", "other")
            )
            alive, matches, start = np.arange(len(batch)), np.zeros(len(batch), np.int64), 0
            for end, least in batches_of:
                matches = matches + (left[alive, start:end] == right[alive, start:end]).sum(axis=1)
                going = matches >= least
                alive, matches, start = alive[going], matches[going], end
            yield batch.iloc[alive][["u", "v"]]

    return prune


#: What is known of a class where it is compared with those of other components.
OUTER = ("node", "component", "signature", "n_shingles", "bits", "others", "marks", "unmarked")


def _matrix(values: np.ndarray) -> np.ndarray:
    """Binary values of equal length, one row each."""
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)


def _common(listed: np.ndarray, own: np.ndarray) -> np.ndarray:
    """How many bits each row has in common with ``own``."""
    return np.bitwise_count(listed & own).sum(axis=1, dtype=np.int64)


def _portion(row: object, ending: str) -> dict[str, np.ndarray]:
    """The listed classes of a row, a NumPy array for each column."""
    listed = {c: np.asarray(getattr(row, f"{c}_{ending}")) for c in OUTER}
    return listed | {c: _matrix(listed[c]) for c in ("signature", "bits", "marks")}


def _prune_outer(percent: int, miss: float, best: bool):
    """The same for a portion of a bucket's classes against a portion of its other components.

    What is left has to be able to reach the threshold by its profile, too. With
    ``best`` two components get one pair a batch, the most similar by that bound.
    """
    batches_of = fewest_matches(percent, miss)

    def promising(own: dict, k: int, other: dict) -> tuple[np.ndarray, np.ndarray]:
        """Places of the others that class ``k`` may be linked with, and the share they may reach."""
        at = np.flatnonzero(other["component"] != own["component"][k])
        same = other["signature"][at] == own["signature"][k]
        alive, start, matches = np.arange(len(at)), 0, np.zeros(len(at), np.int64)
        for end, least in batches_of:
            matches = matches + same[alive, start:end].sum(axis=1)
            going = matches >= least
            alive, matches, start = alive[going], matches[going], end
        at = at[alive]
        # each common further shingle has a common mark, or one it shares with others
        most = _common(other["marks"][at], own["marks"][k])
        most += np.minimum(other["unmarked"][at], own["unmarked"][k])
        most = np.minimum(most, np.minimum(other["others"][at], own["others"][k]))
        most += _common(other["bits"][at], own["bits"][k])
        union = other["n_shingles"][at] + own["n_shingles"][k] - most
        going = 100 * most >= percent * union
        return at[going], most[going] / union[going]

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, chosen = [], {}
            for row in batch.itertuples(index=False):
                own, other = _portion(row, "own"), _portion(row, "other")
                for k, (node, component) in enumerate(
                    zip(own["node"].tolist(), own["component"].tolist(), strict=True)
                ):
                    at, share = promising(own, k, other)
                    pairs = [(min(node, o), max(node, o)) for o in other["node"][at].tolist()]
                    if not best:
                        found += pairs
                        continue
                    components = other["component"][at].tolist()
                    for c, candidate in zip(
                        components, zip(share.tolist(), pairs, strict=True), strict=True
                    ):
                        ends = (min(c, component), max(c, component))
                        chosen[ends] = max(chosen.get(ends, candidate), candidate)
            found += [pair for _, pair in chosen.values()]
            yield pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return prune


def _shingle_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shingler = Shingler()
    for batch in batches:
        for node, text in zip(batch["node"], batch["__text"], strict=True):
            yield pd.DataFrame({"node": node, "shingle": shingler(words_of(text)).view(np.int64)})


def _profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Which shingles of its leader each class has, and how many further ones.

    ``marks`` has a bit for each further one, ``unmarked`` tells how many met
    another's.
    """
    shingler, last, left = Shingler(), None, None
    for batch in batches:
        rows = []
        for leader, node, one, other in batch[["leader", "node", "text_u", "text_v"]].itertuples(
            index=False
        ):
            if leader != last:
                last, left = leader, shingler(words_of(one))
            right = shingler(words_of(other))
            has = np.isin(left, right, assume_unique=True)
            further = np.setdiff1d(right, left, assume_unique=True)
            size = min(max(len(left), MARK_BYTES[0]), MARK_BYTES[1])
            marks = np.zeros(8 * size, bool)
            marks[further % np.uint64(8 * size)] = True
            unmarked = len(further) - int(marks.sum())
            packed = (np.packbits(has).tobytes(), np.packbits(marks).tobytes())
            rows.append((leader, node, *packed, unmarked, len(further)))
        columns = ["leader", "node", "bits", "marks", "unmarked", "further"]
        yield pd.DataFrame(rows, columns=columns)


def _verify(percent: int):
    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, last, left = Shingler(), None, None
        for batch in batches:
            good = []
            for u, one, other in zip(batch["u"], batch["text_u"], batch["text_v"], strict=True):
                if u != last:
                    last, left = u, shingler(words_of(one))
                right = shingler(words_of(other))
                both = len(np.intersect1d(left, right, assume_unique=True))
                good.append(100 * both >= percent * (len(left) + len(right) - both))
            yield batch.loc[np.array(good, bool), ["u", "v"]]

    return verify


#: Rounds after which labels also jump to the label of their label.
SPREAD_ROUNDS = 4


def components(edges: DataFrame, stages: Stages, tag: str) -> DataFrame:
    """``node, component``: the smallest node each node is connected with.

    Each round a node takes the smallest label around it. Groups of copies are
    stars and settle at once; if some do not, labels jump as well, so that
    rounds grow with the logarithm of a chain. Each round is written.
    """
    around = edges.select("u", "v").union(edges.select("v", "u"))

    def smallest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("node").agg(F.min("component").alias("component"))

    def total(labels: DataFrame):
        return labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]

    first = around.select(F.col("u").alias("node"), F.least("u", "v").alias("component"))
    labels = stages.write(f"labels_{tag}_0", smallest(first))
    before = total(labels)
    for k in range(1, 1000):
        spread = around.join(labels.toDF("v", "component"), "v").select("u", "component")
        new = smallest(labels.union(spread))
        if k > SPREAD_ROUNDS:
            new = stages.write(f"spread_{tag}_{k}", new)
            jump = new.toDF("component", "next")
            new = new.join(jump, "component").select("node", F.col("next").alias("component"))
        labels = stages.write(f"labels_{tag}_{k}", new)
        now = total(labels)  # labels only ever fall
        if now == before:
            return labels
        before = now
    raise RuntimeError("components did not settle")


def extended(labels: DataFrame | None, links: DataFrame, stages: Stages, tag: str) -> DataFrame:
    """What :func:`components` gives of all links, from ``labels`` of the earlier ones.

    Of the new links only those between different components go on, each pair
    of components once, so earlier links are not gone through again.
    """
    if labels is None:
        return components(links, stages, tag)
    ends = links.join(labels.toDF("u", "cu"), "u", "left").join(labels.toDF("v", "cv"), "v", "left")
    ends = ends.select(F.coalesce("cu", "u").alias("cu"), F.coalesce("cv", "v").alias("cv"))
    across = ends.filter("cu != cv").select(F.least("cu", "cv").alias("u"), F.greatest("cu", "cv").alias("v"))
    across = stages.write(f"across_{tag}", across.distinct())
    if across.isEmpty():
        return labels
    merged = components(across, stages, tag)
    known = labels.join(merged.toDF("component", "next"), "component", "left")
    known = known.select("node", F.coalesce("next", "component").alias("component"))
    # the node a component is named by is one of its own, so what is left is new
    return stages.write(f"extended_{tag}", known.union(merged.join(labels, "node", "left_anti")))


class _Search:
    """The links of one run: what is known of classes and where it is written."""

    def __init__(self, docs, classes, stages, percent, miss, text_column, id_column) -> None:
        self.classes, self.stages, self.percent, self.miss = classes, stages, percent, miss
        self.texts = docs.select(
            *row_key(id_column, text_column), F.col(text_column).alias("__text")
        )
        self.labels: DataFrame | None = None
        self._count = 0

    def write(self, name: str, df: DataFrame) -> DataFrame:
        self._count += 1
        return self.stages.write(f"{name}_{self._count}", df)

    def compare(self, pairs: DataFrame) -> int:
        """Add the links among pairs ``u < v`` of classes; tell how many there are."""
        signatures = self.classes.select("node", "signature")
        both = pairs.join(signatures.withColumnRenamed("node", "u"), "u").join(
            signatures.toDF("v", "other"), "v"
        )
        pruned = both.mapInPandas(_prune(self.percent, self.miss), "u bigint, v bigint")
        return self.confirm(self.write("survivors", pruned))

    def compare_outer(self, shared: DataFrame, rest: DataFrame) -> None:
        """Add the links between the main component of a bucket and its others.

        One link joins two components, so their best pair is verified first; the
        other pairs follow only where that has left the two apart.
        """
        profiles = self.profiles(rest)
        n_pairs, n_links = self._compare_outer(rest, profiles, best=True)
        if n_links:
            rest = self.mixed(shared)
        if n_pairs and not rest.isEmpty():
            self._compare_outer(rest, profiles, best=False)

    def _compare_outer(self, few: DataFrame, profiles: DataFrame, best: bool) -> tuple[int, int]:
        """How many pairs were verified and are links.

        The classes of a bucket and its others are packed to portions, and each
        portion meets each, so pairs exist only inside a task until they are
        pruned, and a class is sent there once for each portion of others.
        """
        few = few.join(self.classes.select("node", "signature", "n_shingles"), "node")
        few = few.join(profiles, ["leader", "node"])
        signed = self.write("signed_rest", few)

        def packed(rows: DataFrame, size: str, ending: str) -> DataFrame:
            portion = F.expr(f"pmod(xxhash64(node), CAST(ceil({size} / {OUTSIDE}) AS BIGINT))")
            portions = rows.groupBy("bucket", portion.alias("portion"))
            lists = portions.agg(*(F.collect_list(c).alias(f"{c}_{ending}") for c in OUTER))
            return self.write(f"outer_{ending}", lists.drop("portion"))

        own = packed(signed, "classes", "own")
        other = packed(signed.filter("component != main"), "outside", "other")
        both = own.join(other, "bucket").drop("bucket")
        prune = _prune_outer(self.percent, self.miss, best)
        pairs = self.write("survivors", both.mapInPandas(prune, "u bigint, v bigint").distinct())
        return pairs.count(), self.confirm(pairs)

    def profiles(self, few: DataFrame) -> DataFrame:
        """``leader, node, bits, marks, unmarked, others`` of classes, to bound their pairs.

        ``bits`` tells which of the leader's shingles a class has; ``others``
        counts those of its further shingles that any other of these classes
        has, ``marks`` and ``unmarked`` which these are. Two classes share at most
        the bits they have in common and the smaller number of others, or their
        common marks and the smaller number of unmarked.
        """
        pairs = self.write("family", few.select("leader", "node").distinct())
        nodes = pairs.select("node").union(pairs.select("leader")).distinct()
        texts = self.texts_of(nodes)
        sets = texts.mapInPandas(_shingle_rows, "node bigint, shingle bigint")
        single = sets.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node"))
        alone = single.filter("n = 1").groupBy("node").agg(F.count("*").alias("alone"))
        alone = self.write("alone", alone)
        joined = pairs.join(texts.toDF("leader", "text_u"), "leader").join(
            texts.toDF("node", "text_v"), "node"
        )
        profiled = joined.mapInPandas(
            _profile,
            "leader bigint, node bigint, bits binary, marks binary, unmarked bigint, further bigint",
        )
        others = F.greatest(F.col("further") - F.coalesce("alone", F.lit(0)), F.lit(0))
        found = profiled.join(alone, "node", "left")
        known = ("leader", "node", "bits", "marks", "unmarked")
        return self.write("profiles", found.select(*known, others.alias("others")))

    def texts_of(self, nodes: DataFrame) -> DataFrame:
        """``node, __text`` of classes, written."""
        reps = self.classes.select("node", *ROW_KEY).join(nodes, "node")
        reps = self.write("involved", reps.withColumnsRenamed({c: f"{c}_rep" for c in ROW_KEY}))
        if reps.count() <= BROADCAST_CLASSES:  # so that the texts need no shuffle
            reps = F.broadcast(reps)
        on = [self.texts[c].eqNullSafe(reps[f"{c}_rep"]) for c in ROW_KEY]
        texts = self.texts.join(reps, on).select("node", "__text").dropDuplicates(["node"])
        return self.write("texts", texts)

    def confirm(self, kept: DataFrame) -> int:
        """Add the written pairs that are similar by their whole shingle sets; tell how many."""
        if kept.isEmpty():
            return 0
        nodes = kept.select(F.col("u").alias("node")).union(kept.select("v")).distinct()
        texts = self.texts_of(nodes)
        joined = kept.join(texts.toDF("u", "text_u"), "u").join(texts.toDF("v", "text_v"), "v")
        links = self.write("links", joined.mapInPandas(_verify(self.percent), "u bigint, v bigint"))
        n_links = links.count()
        if n_links:
            self._count += 1
            self.labels = extended(self.labels, links, self.stages, str(self._count))
        return n_links

    def _across(self, pairs: DataFrame) -> DataFrame:
        """Pairs of different components."""
        if self.labels is None:
            return pairs
        labels = self.labels
        joined = pairs.join(labels.toDF("u", "cu"), "u", "left").join(labels.toDF("v", "cv"), "v", "left")
        return joined.filter("coalesce(cu, u) != coalesce(cv, v)").select("u", "v")

    def compare_with_leaders(self, pairs: DataFrame) -> None:
        """Compare classes ``v`` with the leaders ``u`` of their buckets.

        A class is in many buckets with leaders of its own group, so it meets
        the first of them; the next only if that left the two apart. Once a
        round links few classes, what is left is compared at a time.
        """
        left = self.write("pairs", pairs)
        while True:
            chosen = left.groupBy("v").agg(F.min("u").alias("u"))
            chosen = self.write("chosen", chosen)
            n_pairs = chosen.count()
            n_links = self.compare(chosen)
            rest = left.join(chosen.toDF("v", "__met"), "v").filter("u > __met").drop("__met")
            left = self.write("pairs", self._across(rest))
            if n_links <= FRUITFUL * n_pairs:
                break
        if not left.isEmpty():
            self.compare(left)

    def mixed(self, shared: DataFrame) -> DataFrame:
        """The classes of buckets that span several components.

        ``main`` is the largest component of a bucket, ``classes`` the number of
        its classes and ``outside`` of those that are in other components.
        """
        labelled = shared
        if self.labels is not None:
            labelled = shared.join(self.labels, "node", "left")
        else:
            labelled = shared.withColumn("component", F.lit(None).cast("bigint"))
        component = F.coalesce("component", "node").alias("component")
        labelled = labelled.select("bucket", "leader", "node", "size", component)
        labelled = self.write("labelled", labelled)
        # two classes have been compared already, as one of them leads
        parts = labelled.filter("size > 2").groupBy("bucket", "component").agg(F.count("*").alias("n"))
        largest = F.max(F.struct("n", "component"))
        mixed = parts.groupBy("bucket").agg(largest.alias("top"), F.sum("n").alias("all"))
        mixed = mixed.filter(F.col("all") > F.col("top.n")).select(
            "bucket",
            F.col("top.component").alias("main"),
            F.col("all").alias("classes"),
            (F.col("all") - F.col("top.n")).alias("outside"),
        )
        mixed = self.write("mixed", mixed)
        return self.write("rest", labelled.drop("size").join(mixed, "bucket"))

    def search(self, buckets: DataFrame) -> None:
        """Link the classes of ``bucket, node`` that share a bucket."""
        leaders = buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("size"))
        leaders = self.write("leaders", leaders.filter("size > 1"))
        shared = self.write("shared", buckets.join(leaders, "bucket"))
        first = shared.filter("node != leader").select(F.col("leader").alias("u"), F.col("node").alias("v"))
        self.compare_with_leaders(first.distinct())

        rest = self.mixed(shared)
        for k in range(1, 1000):
            large = rest.filter(F.col("outside") > LARGE)
            if large.isEmpty():
                break
            drawn = large.filter("component != main").groupBy("bucket").agg(
                F.min(F.struct(F.xxhash64("node", F.lit(k)), "node", "component")).alias("drawn")
            )
            drawn = drawn.select("bucket", F.col("drawn.node").alias("with"), F.col("drawn.component").alias("of"))
            # a class of several large buckets meets one of their drawn classes
            met = large.join(drawn, "bucket").filter(F.col("component") != F.col("of"))
            met = met.groupBy("node").agg(F.min("with").alias("with"))
            ends = (F.least("node", "with").alias("u"), F.greatest("node", "with").alias("v"))
            pairs = self.write("drawn", met.select(*ends).distinct())
            n_pairs, n_links = pairs.count(), self.compare(pairs)
            if n_links:
                rest = self.mixed(shared)
            if n_links <= FEW * n_pairs:
                break
        if not rest.isEmpty():
            self.compare_outer(shared, rest)


def near_duplicates(
    docs: DataFrame,
    stages: Stages,
    percent: int = 75,
    miss: float = MISS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``common.row_key`` columns, ``n_shingles, component_id, kept`` of each row.

    Rows are linked where 100 * intersection >= ``percent`` * union of their
    five-word shingles; ``component_id`` is the smallest id reachable, the
    row's own included. A text of one to four words has one shingle of them
    all; one without words, or NULL, has none, is linked with nothing and is
    kept. Rows with a NULL id take part: they are kept only where nothing they
    are linked with has an id. Repeated rows have equal results, so a kept row
    can be there more than once; :func:`keep_one` leaves one.
    """
    texts = docs.select(*row_key(id_column, text_column), F.col(text_column).alias("__text"))
    signed = stages.write("signed", texts.mapInPandas(_sign, SIGNED))
    keys = ["key_a", "key_b"]
    first = F.struct(*ROW_KEY)
    classes = (
        signed.filter("n_shingles > 0")
        .groupBy(*keys)
        .agg(
            F.min(ROW_KEY[0]).alias("least_id"),
            F.min(first).alias("rep"),
            F.max("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
            F.first("signature").alias("signature"),
        )
        .select(*keys, "least_id", "rep.*", "n_shingles", "bands", "signature")
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = stages.write("classes", classes)
    run = _Search(docs, classes, stages, percent, miss, text_column, id_column)
    run.search(classes.select(F.explode("bands").alias("bucket"), "node"))

    ids = classes.select("node", "least_id")
    if run.labels is not None:
        ids = ids.join(run.labels, "node", "left")
    else:
        ids = ids.withColumn("component", F.lit(None).cast("bigint"))
    ids = stages.write("ids", ids.withColumn("component", F.coalesce("component", "node")))
    smallest = stages.write("smallest", ids.groupBy("component").agg(F.min("least_id").alias("component_id")))
    of_class = ids.join(smallest, "component").select("node", "component_id")
    of_class = stages.write("of_class", classes.select("node", *keys).join(of_class, "node").drop("node"))
    joined = signed.select(*ROW_KEY, *keys, "n_shingles").join(of_class, keys, "left")
    own = F.col(ROW_KEY[0])
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(own)
    return joined.select(
        *ROW_KEY,
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(own == component, component.isNull()).alias("kept"),
    )


def keep_one(
    docs: DataFrame, stages: Stages, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """One row of each group of near copies, the one with the smallest id."""
    found = near_duplicates(docs, stages, id_column=id_column, text_column=text_column, **options)
    kept = stages.write("kept", found.filter("kept").select(*ROW_KEY).distinct())
    kept = kept.withColumnsRenamed({c: f"{c}_kept" for c in ROW_KEY})
    keyed = docs.select("*", *row_key(id_column, text_column))
    on = [keyed[c].eqNullSafe(kept[f"{c}_kept"]) for c in ROW_KEY]
    return keyed.join(kept, on, "left_semi").dropDuplicates(list(ROW_KEY)).select(*docs.columns)

"""SimHash near duplicates, found by deletion-variant signatures.

A text's fingerprint has a bit where more than half of its shingles' hashes have
it. Fingerprints that differ by at most 4 of 64 bits are linked. Of three
segments one then differs by at most one bit: were it two in each, there would
be six. So each segment is indexed with one bit deleted, for each of its bits
in turn, and two linked fingerprints share such a variant: the one without the
bit they differ by. Fingerprints that share a variant are verified.

Texts with equal fingerprints are one node. A variant's nodes form a bucket. At
first every node of a bucket is compared with one of them, drawn by a hash that
changes from round to round, as long as that adds many links: a dense group of
nodes becomes one component by about one link a node. Only pairs of nodes that
are still in different components are left then; buckets that hold such are
joined with themselves, and the join's condition is the verification, so a
pair that is no link never becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources import Stages
from .common import ROW_KEY, row_key
from .near_dedup import components, words_of

SHINGLE = 4
SEED = 42
RADIUS = 4
BITS = 64
#: Hashes counted at a time, so that a long text needs no more memory.
CHUNK = 4096
#: Fingerprints outside a bucket's first component that the others meet at a time.
PORTION = 4096
#: A round that adds links for no more than this share of the nodes is the last.
FEW = 0.02
FINGERPRINTED = f"{ROW_KEY[0]} bigint, {ROW_KEY[1]} bigint, {ROW_KEY[2]} bigint, fingerprint bigint"


def _hashes(words: list[bytes]) -> Iterator[np.ndarray]:
    """XXH64 of the shingles, some at a time."""
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        yield np.array([digest(joined, SEED)], np.uint64)
        return
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    for first in range(0, len(words) - SHINGLE + 1, CHUNK):
        one = starts[first : first + CHUNK].tolist()
        last = ends[first + SHINGLE - 1 : first + SHINGLE - 1 + CHUNK].tolist()
        found = [digest(joined[a:b], SEED) for a, b in zip(one, last, strict=False)]
        yield np.array(found, np.uint64)


def fingerprint(text: str | None) -> int:
    """The fingerprint, unsigned; 0 of a text without words."""
    words = words_of(text)
    if not words:
        return 0
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in _hashes(words):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = np.fromiter(map(fingerprint, batch["__text"]), np.uint64, len(batch))
        yield batch.drop(columns="__text").assign(fingerprint=found.view(np.int64))


def segments(radius: int = RADIUS) -> list[tuple[int, int]]:
    """Shift and width of the segments, one of which differs by at most one bit."""
    count = radius // 2 + 1
    cuts = [BITS * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def variants(fingerprint: Column, radius: int = RADIUS) -> Column:
    """The keys of all segments with one bit deleted; a key tells which bit."""
    keys, number = [], 0
    for shift, width in segments(radius):
        part = F.shiftrightunsigned(fingerprint, shift).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(width):
            low = part.bitwiseAND(F.lit((1 << bit) - 1))
            high = F.shiftleft(F.shiftright(part, bit + 1), bit)
            keys.append(high.bitwiseOR(low) + F.lit(number << (BITS // (radius // 2 + 1) + 1)))
            number += 1
    return F.array(*keys)


def _distance(one: Column, other: Column) -> Column:
    return F.bit_count(one.bitwiseXOR(other))


def _labelled(nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``node, component`` of all nodes; one without links is its own component."""
    if labels is None:
        return nodes.select("node", F.col("node").alias("component"))
    found = nodes.select("node").join(labels, "node", "left")
    return found.select("node", F.coalesce("component", "node").alias("component"))


def _buckets(labelled: DataFrame, radius: int) -> DataFrame:
    """``key, node, component`` of the variants that several components share."""
    rows = labelled.select(F.explode(variants(F.col("node"), radius)).alias("key"), "node", "component")
    of_key = Window.partitionBy("key")
    ends = rows.withColumns(
        {"__low": F.min("component").over(of_key), "__high": F.max("component").over(of_key)}
    )
    return ends.filter("__low != __high").drop("__low", "__high")


def _verified(rows: DataFrame, few: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """Links ``u, v`` between ``rows`` and ``few`` with equal keys and other components."""
    few = few.select(
        *(F.col(k).alias(f"__{k}") for k in keys), F.col("node").alias("u"), F.col("component").alias("cu")
    )
    on = (F.col("cu") != F.col("component")) & (_distance(F.col("u"), F.col("node")) <= radius)
    for key in keys:
        on = on & (F.col(key) == F.col(f"__{key}"))
    return rows.join(few, on).select("u", F.col("node").alias("v"))


def link(nodes: DataFrame, stages: Stages, radius: int = RADIUS) -> DataFrame:
    """``node, component`` of distinct fingerprints ``node``; see the module.

    When the rounds of drawn nodes end decides only how much is left to the
    join, which finds every link between different components.
    """
    edges, labels, k = None, None, 0
    labelled = stages.write("nodes_0", _labelled(nodes, labels))
    few_links = labelled.count() * FEW

    def add(found: DataFrame) -> int:
        """Take new links in; tell how many there are."""
        nonlocal edges, labels, labelled, k
        found = stages.write(f"links_{k}", found.distinct())
        k += 1
        n_links = found.count()
        if n_links:
            edges = found if edges is None else edges.unionByName(found)
            labels = components(edges, stages, f"simhash_{k}")
            labelled = stages.write(f"nodes_{k}", _labelled(nodes, labels))
        return n_links

    while True:
        drawn = F.min(F.struct(F.xxhash64("node", F.lit(k)), "node", "component"))
        drawn = drawn.over(Window.partitionBy("key"))
        stars = _buckets(labelled, radius).withColumns({"u": drawn["node"], "cu": drawn["component"]})
        near = (F.col("cu") != F.col("component")) & (_distance(F.col("u"), F.col("node")) <= radius)
        if add(stars.filter(near).select("u", F.col("node").alias("v"))) <= few_links:
            break

    # in a bucket, all nodes meet those outside its largest component
    of_key, of_part = Window.partitionBy("key"), Window.partitionBy("key", "component")
    rest = _buckets(labelled, radius).withColumn("__n", F.count(F.lit(1)).over(of_part))
    largest = F.max(F.struct("__n", "component")).over(of_key)
    rest = rest.withColumns({"__largest": largest, "__all": F.count(F.lit(1)).over(of_key)})
    rest = rest.select(
        "key",
        "node",
        "component",
        (F.col("component") == F.col("__largest.component")).alias("inside"),
        (F.col("__all") - F.col("__largest.__n")).alias("outside"),
    )
    rest = stages.write("rest", rest)
    small = F.col("outside") <= PORTION
    found = _verified(rest.filter(small), rest.filter(small & ~F.col("inside")), ["key"], radius)
    portions = F.ceil(F.col("outside") / PORTION).cast("int")
    large = rest.filter(~small)
    every = large.withColumn("portion", F.explode(F.sequence(F.lit(0), portions - 1)))
    own = F.pmod(F.xxhash64("node"), portions).cast("int")
    few = large.filter(~F.col("inside")).withColumn("portion", own)
    add(found.unionByName(_verified(every, few, ["key", "portion"], radius)))
    return labelled


def near_duplicates(
    docs: DataFrame,
    stages: Stages,
    radius: int = RADIUS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``common.row_key`` columns, ``fingerprint, component_id`` of each row.

    ``component_id`` is the smallest id reachable by links, the row's own
    included. A text of fewer than four words has one shingle of them all; one
    without words, or NULL, has fingerprint 0 and is linked like any other.
    Rows with a NULL id take part and get the component of what they are linked
    with, NULL if nothing there has an id. Repeated rows have equal results.
    ``fingerprint`` is a signed number of 64 bits.
    """
    texts = docs.select(*row_key(id_column, text_column), F.col(text_column).alias("__text"))
    signed = stages.write("fingerprints", texts.mapInPandas(_sign, FINGERPRINTED))
    nodes = signed.groupBy(F.col("fingerprint").alias("node")).agg(F.min(ROW_KEY[0]).alias("least_id"))
    nodes = stages.write("distinct", nodes)
    labelled = link(nodes, stages, radius).join(nodes, "node")
    smallest = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_node = labelled.select("component", "node").join(smallest, "component")
    of_node = stages.write("of_node", of_node.select(F.col("node").alias("fingerprint"), "component_id"))
    return signed.join(of_node, "fingerprint", "left").select(*ROW_KEY, "fingerprint", "component_id")

"""Ranked lexical search with queries and documents in changed roles.

The few items asked for are indexed: an inverted index leads from each of their
terms to the items that hold it. It is broadcast, and the documents stream
through it, once to count and once to score: a task keeps a bounded heap of the
best documents for each item, and the heaps are merged. Whatever does not hold
a term of any item is never shuffled.

Items are taken in blocks whose index has a bounded size, so any number of them
can be asked for; what is in memory does not depend on the number of documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..sources import Stages

LIMIT = 10
#: Postings and items of a block, which bound its index, its counts on the driver
#: and the heaps of a task.
BLOCK_POSTINGS = 500_000
BLOCK_ITEMS = 1_000
#: Scores held at a time by a task.
SCORES = 1 << 20
#: Bytes of a text split at a time.
CHUNK = 1 << 20
#: Tasks' heaps are merged in groups first.
GROUPS = 64

# Bytes that end a term (all ASCII but digits and letters) and upper case.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or bytes([c]).isalnum() else 32 for c in range(256))

COUNTED = "doc_id bigint, n_terms bigint, terms array<int>, tfs array<bigint>"
HEAPS = "item int, doc_id bigint, score bigint"


def pieces(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, some at a time."""
    plain = (text or "").encode("utf-8", "surrogatepass").translate(_TERMS)
    start = 0
    while start < len(plain):
        end = plain.find(b" ", start + CHUNK)
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end


@dataclass(frozen=True)
class Index:
    """Items of a block: their ids, and the items that hold each term."""

    items: list[int | None]
    number_of: dict[bytes, int]
    starts: np.ndarray
    postings: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[int | None, list[bytes]]]) -> Index:
        held: dict[bytes, list[int]] = {}
        for number, (_, terms) in enumerate(items):
            for term in terms:
                held.setdefault(term, []).append(number)
        sizes = [len(p) for p in held.values()]
        flat = [i for p in held.values() for i in p]
        return cls(
            [item for item, _ in items],
            {term: k for k, term in enumerate(held)},
            np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))),
            np.array(flat, np.int64),
        )


def _distinct_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [sorted(set().union(*pieces(text))) for text in batch["text"]]
        yield pd.DataFrame({"item_id": batch["item_id"], "terms": found})


def blocks_of(items: DataFrame, stages: Stages) -> Iterator[Index]:
    """Indexes of all items; an item larger than a block gets one of its own."""
    terms = items.select("item_id", "text").mapInPandas(
        _distinct_terms, "item_id bigint, terms array<binary>"
    )
    written = stages.write("items", terms.filter(F.size("terms") > 0))
    block, postings = [], 0
    for row in written.toLocalIterator():
        if block and (postings + len(row.terms) > BLOCK_POSTINGS or len(block) == BLOCK_ITEMS):
            yield Index.of(block)
            block, postings = [], 0
        block.append((row.item_id, [bytes(t) for t in row.terms]))
        postings += len(row.terms)
    if block:
        yield Index.of(block)


def _count(number_of):
    """How often each document holds the terms of the index, and all its terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = number_of.value.get
        for batch in batches:
            n_terms, numbers, times = [], [], []
            for text in batch.column("text"):
                total, found = 0, Counter()
                for words in pieces(text.as_py()):
                    total += len(words)
                    found.update(map(get, words))
                found.pop(None, None)
                n_terms.append(total)
                numbers.append(list(found))
                times.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_terms, pa.int64()),
                    pa.array(numbers, pa.list_(pa.int32())),
                    pa.array(times, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_terms", "terms", "tfs"],
            )

    return count


class Heaps:
    """The best documents of each item: highest score, then lowest id, no id last."""

    def __init__(self, n_items: int, limit: int) -> None:
        self._limit, self._least = limit, np.ones(n_items, np.int64)
        none = np.zeros(0, np.int64)
        self.item, self.score, self.doc, self.no_id = none, none, none, none.astype(bool)

    def add(self, item, score, doc, no_id) -> None:
        """Take in candidates; those below the last of a full heap fall away first."""
        at = np.flatnonzero(score >= self._least[item])
        if not len(at):
            return
        item = np.concatenate((self.item, item[at]))
        score = np.concatenate((self.score, score[at]))
        doc = np.concatenate((self.doc, doc[at]))
        no_id = np.concatenate((self.no_id, no_id[at]))
        order = np.lexsort((doc, no_id, -score, item))
        item, score, doc, no_id = item[order], score[order], doc[order], no_id[order]
        first = np.searchsorted(item, item)
        rank = np.arange(len(item)) - first
        kept = rank < self._limit
        last = rank == self._limit - 1
        self._least[item[last]] = score[last]
        self.item, self.score, self.doc, self.no_id = item[kept], score[kept], doc[kept], no_id[kept]


def _rank(index, limit: int):
    """The heaps of the documents of a task; ``index`` is a broadcast of the block."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, postings, weights, n_docs, n_all, n_items = index.value
        heaps, at_once = Heaps(n_items, limit), max(1, SCORES // n_items)
        for whole in batches:
            for first in range(0, len(whole), at_once):
                batch = whole.slice(first, at_once)
                terms, tfs = batch.column("terms"), batch.column("tfs")
                n = batch.column("n_terms").to_numpy()
                row = np.repeat(np.arange(len(batch)), np.diff(terms.offsets.to_numpy()))
                term = terms.flatten().to_numpy().astype(np.int64)
                tf = tfs.flatten().to_numpy()
                norm = 100 - 90 + (90 * n * n_docs) // n_all
                gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * norm[row]))
                # each term of a document adds to the items of its postings
                sizes = starts[term + 1] - starts[term]
                ends = np.cumsum(sizes)
                within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
                item = postings[np.repeat(starts[term], sizes) + within]
                scores = np.zeros(len(batch) * n_items, np.int64)
                np.add.at(scores, np.repeat(row * n_items, sizes) + item, np.repeat(gain, sizes))
                some = np.flatnonzero(scores > 0)
                ids = batch.column("doc_id")
                no_id = ids.is_null().to_numpy(zero_copy_only=False)
                doc = ids.fill_null(0).to_numpy()
                doc_row = some // n_items
                heaps.add(some % n_items, scores[some], doc[doc_row], no_id[doc_row])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(heaps.item, pa.int32()),
                pa.array(heaps.doc, pa.int64(), mask=heaps.no_id),
                pa.array(heaps.score, pa.int64()),
            ],
            ["item", "doc_id", "score"],
        )

    return rank


def weights_of(df: dict[int, int], n_terms: int, n_docs: int) -> np.ndarray:
    """The weight of each term of an index, by how many documents hold it."""
    return np.array(
        [
            math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(k, 0) + 1)))
            for k in range(n_terms)
        ],
        np.int64,
    )


def _search_block(docs: DataFrame, index: Index, stages: Stages, tag: str, limit: int) -> DataFrame:
    spark = docs.sparkSession
    number_of = spark.sparkContext.broadcast(index.number_of)
    counted = docs.select("doc_id", "text").mapInArrow(_count(number_of), COUNTED)
    counted = stages.write(f"counted_{tag}", counted.filter("n_terms > 0"))
    n_docs, n_all = counted.agg(F.count(F.lit(1)), F.sum("n_terms")).first()
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)))
    df = dict(held.toArrow().to_pandas().itertuples(index=False, name=None))  # one row a term
    weights = weights_of(df, len(index.number_of), n_docs)
    parts = (index.starts, index.postings, weights, n_docs, n_all or 1, len(index.items))
    heaps = counted.filter(F.size("terms") > 0).mapInArrow(
        _rank(spark.sparkContext.broadcast(parts), limit), HEAPS
    )
    heaps = stages.write(f"heaps_{tag}", heaps.withColumn("__group", F.spark_partition_id() % GROUPS))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["item", "__group"], ["item"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        heaps = heaps.withColumn("rank", rank).filter(F.col("rank") <= limit)
    ids = [(k, item) for k, item in enumerate(index.items)]
    named = spark.createDataFrame(ids, "item int, item_id bigint")
    return heaps.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, stages: Stages, limit: int = LIMIT) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best documents of each item.

    Terms are runs of digits, letters and all that is not ASCII, A-Z in lower
    case. A document's score adds up, over the item's distinct terms, a weight
    that falls with the number of documents that hold the term times a share
    that rises with its occurrences and falls with the document's length, all
    in whole numbers. Only scores above 0 are ranked; equal ones by ascending
    id, rows without an id last. Every row of ``docs`` is a document and every
    row of ``items`` an item, ids repeated or not, so repeated items have their
    ranks repeated. NULL and texts without terms are no documents, and find
    nothing as items. Further columns are left out.
    """
    found = None
    for k, index in enumerate(blocks_of(items, stages)):
        block = stages.write(f"ranked_{k}", _search_block(docs, index, stages, str(k), limit))
        found = block if found is None else found.unionByName(block)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return found

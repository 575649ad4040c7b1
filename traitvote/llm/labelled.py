"""Bounded samples of labelled documents, to fit models on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def bounded_sample(rows: DataFrame, size: int, order: str) -> DataFrame:
    """The ``size`` rows with the smallest hash of ``order``, at most.

    Nearly all others are dropped in their own task first, so the few that are
    left can be sorted however many there were.
    """
    total = rows.count()
    keyed = rows.withColumn("__order", F.xxhash64(order))
    if total > 2 * size:
        limit = min(2**63 - 1, int(-(2**63) + 1.5 * size / total * 2**64))
        keyed = keyed.filter(F.col("__order") <= F.lit(limit).cast("bigint"))
    return keyed.orderBy("__order", order).limit(size).drop("__order")


def quality_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, quality`` once for each document; of several labels the mean decides."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    return known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))


def labelled_texts(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """``doc_id, text, quality`` of a sample of at most ``size`` labels.

    The sample has a proven bound, so it is broadcast to the documents. An id
    with several rows gives one, the one whose text has the smallest hash.
    """
    sample = bounded_sample(quality_labels(labels), size, "doc_id")
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    return rows.groupBy("doc_id", "quality").agg(
        F.min_by("text", F.xxhash64("text")).alias("text")
    ).select("doc_id", "text", "quality")

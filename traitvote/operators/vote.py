"""The vote: one consensus label per taxon."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import LABEL_PRIORITY, SHARE_DIGITS
from ..functions import label_priority, share
from .counts import keys_of


def with_priority(counts: DataFrame, priority: Mapping[str, int] = LABEL_PRIORITY) -> DataFrame:
    """Add ``gf_size``, the rank of a label in a tied vote."""
    return counts.withColumn("gf_size", label_priority(F.col("gf"), priority))


def _label_list() -> Column:
    return F.array_join(F.sort_array(F.collect_list("gf")), ",").alias("gf_all")


def all_labels(counts: DataFrame, rank: str) -> DataFrame:
    """Every label of a taxon, sorted, comma-separated."""
    return counts.groupBy(rank).agg(_label_list())


def consensus(
    counts: DataFrame,
    rank: str,
    priority: Mapping[str, int] = LABEL_PRIORITY,
    digits: int | None = None,
) -> DataFrame:
    """The label with most votes per taxon; the larger form wins a tie.

    ``counts`` has one row per taxon and label, so a group is as long as a
    taxon has labels. Winner, total and label list come out of one
    aggregation. The taxon is the name at ``rank`` alone: rows of one name
    under several parents compete, and a label may then be listed twice.
    Remaining ties go to the first label, then the first parent names.
    """
    parents = keys_of(rank)[:-1]
    by_rank = "inferred_from_ranks" in counts.columns
    votes = with_priority(counts.filter(F.col("gf").isNotNull()), priority)
    best = F.min(
        F.struct(
            (-F.col("obs")).alias("votes"),
            (-F.col("gf_size")).alias("size"),
            "gf",
            *parents,
        )
    )
    listed = [_label_list()]
    if by_rank:
        seen = F.flatten(F.collect_list(F.split("inferred_from_ranks", ",")))
        listed.append(
            F.array_join(F.array_sort(F.array_distinct(seen)), ",").alias("inferred_from_ranks")
        )
    first = F.col("__best")
    return (
        votes.filter(F.col(rank).isNotNull())
        .groupBy(rank)
        .agg(best.alias("__best"), F.sum("obs").alias("total_obs"), *listed)
        .withColumn("gf_cons_obs", -first["votes"])
        .select(
            *(first[p].alias(p) for p in parents),
            rank,
            first["gf"].alias("gf_cons"),
            "gf_cons_obs",
            "total_obs",
            share(
                F.col("gf_cons_obs"),
                F.col("total_obs"),
                SHARE_DIGITS[rank] if digits is None else digits,
            ).alias("gf_cons_prop"),
            "gf_all",
            *(["inferred_from_ranks"] if by_rank else []),
        )
    )

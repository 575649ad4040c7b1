"""Cleaning of attributions: placement, rank, labels, early counting."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import FAMILY, GENUS, RANKS, SPECIES
from ..functions import blank_to_null, clean_label


def as_attributions(
    df: DataFrame,
    id: str,
    label: str,
    family: str = "scrubbed_family",
    genus: str = "scrubbed_genus",
    species: str = "scrubbed_species_binomial",
) -> DataFrame:
    """Project a source to ``id, family, genus, species, label``."""
    return df.select(
        F.col(id).alias("id"),
        F.col(family).alias(FAMILY),
        F.col(genus).alias(GENUS),
        F.col(species).alias(SPECIES),
        F.col(label).alias("label"),
    )


def drop_unplaced(df: DataFrame) -> DataFrame:
    """Drop rows that name no taxon at any rank."""
    return df.filter(reduce(or_, (F.col(rank).isNotNull() for rank in RANKS)))


def rank_of() -> Column:
    """Finest rank a row names; only NULLs decide, blanks count as names."""
    return (
        F.when(F.col(SPECIES).isNotNull(), SPECIES)
        .when(F.col(GENUS).isNotNull(), GENUS)
        .when(F.col(FAMILY).isNotNull(), FAMILY)
    )


def with_rank(df: DataFrame) -> DataFrame:
    return df.withColumn("applies_to_rank", rank_of())


def clean_labels(df: DataFrame, label: str = "label", strip: Iterable[str] = ("*",)) -> DataFrame:
    """Normalise the label column; labels with nothing left become NULL."""
    return df.withColumn(label, clean_label(F.col(label), strip))


def clean_attributions(
    df: DataFrame, label: str = "label", strip: Iterable[str] = ("*",)
) -> DataFrame:
    """Placed rows with their rank and a clean, non-NULL label."""
    return clean_labels(with_rank(drop_unplaced(df)), label, strip).filter(
        F.col(label).isNotNull()
    )


def collapse(df: DataFrame, *by: str, weight: str | None = None) -> DataFrame:
    """Replace equal rows by one row and their number ``n``.

    All later steps depend only on the names and the label, so this runs right
    after the scan: counting starts before the shuffle, and everything
    downstream handles distinct (taxon, label) rows instead of records.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(*by).agg(n.alias("n"))


def exclude_taxa(df: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Drop rows whose three names equal an exclusion; blank counts as NULL."""
    rules = exclusions.select(*(blank_to_null(F.col(r)).alias(f"__{r}") for r in RANKS))
    same = [blank_to_null(F.col(r)).eqNullSafe(F.col(f"__{r}")) for r in RANKS]
    return df.join(rules, same, "left_anti")

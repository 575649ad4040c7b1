"""Names that occur under more than one parent, and their review table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..constants import FAMILY, GENUS, SPECIES


def homonym_names(df: DataFrame, child: str, parent: str = FAMILY) -> DataFrame:
    """The children with several parents, and no more than one row of each shuffled.

    The smallest and the largest hash of a child's parents differ if there are
    several. Numbers, unlike names, fit a hash aggregate, which starts before
    the shuffle; two hashes leave no room for chance.
    """
    hashes = [F.xxhash64(F.lit(k), parent) for k in range(2)]
    known = df.filter(F.col(child).isNotNull() & F.col(parent).isNotNull())
    ends = [(F.min(h), F.max(h)) for h in hashes]
    several = reduce(lambda a, b: a | b, (low != high for low, high in ends))
    return known.groupBy(child).agg(several.alias("__several")).filter("__several").select(child)


def homonym_pairs(
    df: DataFrame,
    child: str,
    parent: str = FAMILY,
    write: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Distinct (child, parent) pairs of every child with several parents.

    A NULL parent does not make a name a homonym, but is listed once it is one.
    Pairs are made distinct first, so the group of a child is never longer
    than the list of parents, however many records it has. With ``write``, such
    as ``stages.keep(name)``, the few names are found first: the rows are read
    twice, but only those of homonyms are ever shuffled as pairs.
    """
    if write is not None:
        names = write(homonym_names(df, child, parent).withColumnRenamed(child, "__name"))
        return df.join(names, F.col(child) == F.col("__name"), "left_semi").select(child, parent).distinct()
    pairs = df.filter(F.col(child).isNotNull()).select(child, parent).distinct()
    parents = F.count(parent).over(Window.partitionBy(child))
    return pairs.withColumn("__n", parents).filter("__n > 1").drop("__n")


def homonym_summary(pairs: DataFrame, child: str, name: str) -> DataFrame:
    """How many children have homonyms, and how many surplus pairs there are."""
    children = F.count_distinct(child)
    return pairs.agg(
        children.alias(f"{name}_with_homonyms"),
        (F.count(F.lit(1)) - children).alias("homonyms"),
    )


def flag_homonyms(pairs: DataFrame, flags: DataFrame) -> DataFrame:
    """Mark the (genus, family) pairs a person judged; NULL families match."""
    judged = (
        flags.groupBy(F.col(GENUS).alias("__genus"), F.col(FAMILY).alias("__family"))
        .agg(
            F.max("is_homonym_genus").alias("__homonym"),
            F.max("check_species").alias("__check"),
        )
    )
    same = [F.col(GENUS) == F.col("__genus"), F.col(FAMILY).eqNullSafe(F.col("__family"))]
    off = F.lit(0).cast("smallint")
    return pairs.join(judged, same, "left").select(
        GENUS,
        FAMILY,
        F.coalesce("__homonym", off).alias("is_homonym_genus"),
        F.coalesce("__check", off).alias("check_species"),
    )


def homonym_review(flagged: DataFrame, df: DataFrame) -> DataFrame:
    """Distinct (genus, family, species) of the flagged pairs.

    A pair without rows keeps one line with a NULL species. The rows are cut
    to the flagged pairs before the outer join, so that only the short list is
    ever broadcast and the long table is never shuffled whole.
    """
    pair = [GENUS, FAMILY]
    homonyms = flagged.filter("is_homonym_genus = 1").select(*pair).distinct()
    triples = df.join(homonyms, pair, "left_semi").select(*pair, SPECIES).distinct()
    return homonyms.join(triples, pair, "left").select(*pair, SPECIES)

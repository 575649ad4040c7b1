"""Exact distinct counts of species that can be merged: one bit for each species.

Species get dense numbers, in the order of their family and genus, so a taxon's
species lie next to each other and its bits fit into few bitmaps. Bitmaps of
several batches are OR-ed; a species in two of them counts once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..constants import FAMILY, GENUS, SPECIES
from ..sources import Stages, write_ordered


def number_species(
    taxa: DataFrame, stages: Stages, known: DataFrame | None = None
) -> DataFrame:
    """``species, number`` of every species name, numbered without gaps from 1.

    With ``known``, numbers given earlier, those stay and new species get the
    numbers after them, so that bitmaps made with the earlier ones stay valid.
    """
    names = taxa.filter(F.col(SPECIES).isNotNull())
    first = 1
    if known is not None:
        names = names.join(known.select(SPECIES), SPECIES, "left_anti")
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(1))).first()[0]
    homes = names.groupBy(SPECIES).agg(F.min(F.struct(FAMILY, GENUS)).alias("__home"))
    write = stages.keep("numbers")
    ordered = write_ordered(homes, "__home", SPECIES, stages=stages, name="species")
    new = ordered.numbered("number").select(SPECIES, (F.col("number") + first).alias("number"))
    return write(new if known is None else known.select(SPECIES, "number").unionByName(new))


def species_bitmaps(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """``rank, taxon, bucket, bitmap`` of the species of every genus and family.

    One pass over ``rows``: each is expanded to its genus and its family. A bitmap
    has 32,768 bits; ``bucket`` tells which species they stand for.
    """
    numbered = rows.join(numbers, SPECIES).withColumn("bucket", F.bitmap_bucket_number("number"))
    family, genus, bucket = F.col(FAMILY), F.col(GENUS), F.col("bucket")
    bits = numbered.groupingSets([[genus, bucket], [family, bucket]], family, genus, bucket).agg(
        F.grouping(GENUS).alias("__coarse"),
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"),
    )
    coarse = F.col("__coarse") == 1
    return bits.select(
        F.when(coarse, FAMILY).otherwise(GENUS).alias("rank"),
        F.when(coarse, family).otherwise(genus).alias("taxon"),
        "bucket",
        "bitmap",
    )


def merge_bitmaps(*batches: DataFrame) -> DataFrame:
    """The bitmaps of all batches together."""
    rows = reduce(DataFrame.unionByName, batches)
    return rows.groupBy("rank", "taxon", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_species(bitmaps: DataFrame, name: str = "spp") -> DataFrame:
    """``rank, taxon`` and the number of its distinct species."""
    return bitmaps.groupBy("rank", "taxon").agg(F.sum(F.bitmap_count("bitmap")).alias(name))


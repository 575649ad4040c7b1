"""Counting attributions per taxon and label, merging sources, rolling up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import FAMILY, GENUS, RANKS, SPECIES


def at_rank(rank: str) -> Column:
    """Rows that name a taxon of this rank and, for coarse ranks, nothing finer."""
    family, genus, species = (F.col(r) for r in RANKS)
    return {
        SPECIES: species.isNotNull(),
        GENUS: genus.isNotNull() & species.isNull(),
        FAMILY: family.isNotNull() & genus.isNull() & species.isNull(),
    }[rank]


def keys_of(rank: str) -> list[str]:
    """Name columns down to ``rank``, coarsest first."""
    return list(RANKS[: RANKS.index(rank) + 1])


def count_attributions(
    df: DataFrame, rank: str | None = None, label: str = "gf_std", weight: str | None = None
) -> DataFrame:
    """Number of attributions per taxon of ``rank`` and standard label.

    Without ``rank`` all ranks are counted at once; the names finer than the
    rank of a row are then NULL.
    """
    obs = F.sum(weight) if weight else F.count(F.lit(1))
    rows = df.filter(F.col(label).isNotNull())
    if rank:
        rows = rows.filter(at_rank(rank))
    return rows.groupBy(*keys_of(rank or SPECIES), F.col(label).alias("gf")).agg(obs.alias("obs"))


def stack_counts(*counts: DataFrame) -> DataFrame:
    """Counts of several ranks under each other, finer names NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)


#: Sources or ranks that fit into the bits of one number.
BITS = 63


def _bit(position: int) -> Column:
    return F.lit(1 << position).cast("bigint")


def _names_in(tags: Sequence[Column], names: Sequence[str]) -> Column:
    """The names whose bit is set, in ascending order, comma-separated."""
    listed = sorted((name, position) for position, name in enumerate(names))
    seen = (
        F.when(tags[position // BITS].bitwiseAND(_bit(position % BITS)) != 0, name)
        for name, position in listed
    )
    return F.concat_ws(",", *seen)


def _rank_bit(rank: str) -> Column:
    return _bit(RANKS.index(rank))


def _in_ranks(tags: Column) -> Column:
    return _names_in([tags], RANKS).alias("inferred_from_ranks")


def merge_counts(counts: Mapping[str, DataFrame], tasks: int | None = None) -> DataFrame:
    """Sum the counts of several sources and list the sources of each.

    Inputs have ``obs`` per taxon and label ``gf``, or parts of it that are
    still to be summed. Rows without a family are dropped. The set of sources
    travels through the shuffle as bits of one number for every 63 of them,
    which keeps this a plain hash aggregate that starts before the shuffle.

    ``tasks`` deals the rows to so many tasks instead, for long inputs that are
    counted already; a name is then in few of them, whatever it had of records.
    """
    keys = keys_of(SPECIES)
    groups = range((len(counts) + BITS - 1) // BITS)

    def tags(position: int) -> list[Column]:
        own, place = divmod(position, BITS)
        return [(_bit(place) if g == own else F.lit(0).cast("bigint")).alias(f"__tags{g}") for g in groups]

    tagged = [
        df.select(*keys, "gf", "obs", *tags(position))
        for position, df in enumerate(counts.values())
    ]
    rows = reduce(DataFrame.unionByName, tagged).filter(F.col(FAMILY).isNotNull())
    if tasks:
        rows = rows.repartition(tasks, *keys, "gf")
    return (
        rows.groupBy(*keys, "gf")
        .agg(F.sum("obs").alias("obs"), *(F.bit_or(f"__tags{g}").alias(f"__tags{g}") for g in groups))
        .withColumn("obs_sources", _names_in([F.col(f"__tags{g}") for g in groups], list(counts)))
        .drop(*(f"__tags{g}" for g in groups))
    )


def genus_obs(counts: DataFrame) -> DataFrame:
    """Votes per (family, genus, label) from species and genus records.

    ``counts`` holds all ranks. ``inferred_from_ranks`` lists the ranks the
    label of a genus was seen at, over all families the genus occurs in; the
    window for it sees one row per family.
    """
    tags = F.when(F.col(SPECIES).isNotNull(), _rank_bit(SPECIES)).otherwise(_rank_bit(GENUS))
    over_families = F.bit_or("__tags").over(Window.partitionBy(GENUS, "gf"))
    return (
        counts.filter(F.col(FAMILY).isNotNull() & F.col(GENUS).isNotNull())
        .groupBy(FAMILY, GENUS, "gf")
        .agg(F.sum("obs").alias("obs"), F.bit_or(tags).alias("__tags"))
        .select(FAMILY, GENUS, "gf", _in_ranks(over_families), "obs")
    )


def family_obs(counts: DataFrame, double_count: bool = True) -> DataFrame:
    """Votes per (family, label) from species, genus and family records.

    A record of a species counts twice, once as itself and once as part of
    its genus, and is listed under both ranks. That is the defined result;
    ``double_count=False`` counts every record once.
    """
    of_species, has_genus = F.col(SPECIES).isNotNull(), F.col(GENUS).isNotNull()
    twice = of_species & has_genus & F.lit(double_count)
    tags = (
        F.when(twice, _rank_bit(SPECIES).bitwiseOR(_rank_bit(GENUS)))
        .when(of_species, _rank_bit(SPECIES))
        .when(has_genus, _rank_bit(GENUS))
        .otherwise(_rank_bit(FAMILY))
    )
    votes = F.col("obs") * F.when(twice, 2).otherwise(1)
    return (
        counts.filter(F.col(FAMILY).isNotNull())
        .groupBy(FAMILY, "gf")
        .agg(F.sum(votes).alias("obs"), F.bit_or(tags).alias("__tags"))
        .select(FAMILY, "gf", _in_ranks(F.col("__tags")), "obs")
    )


def roll_up(counts: DataFrame, double_count: bool = True) -> DataFrame:
    """The votes of genera and families from one pass over the counts of all ranks.

    Every row is expanded to the keys it votes under, which are summed before
    and after one shuffle: (family, genus, label), (genus, label) over all
    families, (family, label). ``genus_votes`` and ``family_votes`` read the
    result, which is short; write it to have it computed once.
    """
    of_species, has_genus = F.col(SPECIES).isNotNull(), F.col(GENUS).isNotNull()
    twice = of_species & has_genus & F.lit(double_count)
    in_genus = F.when(of_species, _rank_bit(SPECIES)).otherwise(_rank_bit(GENUS))
    in_family = (
        F.when(twice, _rank_bit(SPECIES).bitwiseOR(_rank_bit(GENUS)))
        .when(of_species, _rank_bit(SPECIES))
        .when(has_genus, _rank_bit(GENUS))
        .otherwise(_rank_bit(FAMILY))
    )
    # hashes, as a hash aggregate keeps numbers but no texts
    parents = {f"__parent{k}": F.xxhash64(F.lit(k), FAMILY) for k in range(2)}
    rows = counts.filter(F.col(FAMILY).isNotNull()).select(
        *keys_of(GENUS),
        "gf",
        "obs",
        (F.col("obs") * F.when(twice, 2).otherwise(1)).alias("votes"),
        in_genus.alias("in_genus"),
        in_family.alias("in_family"),
        *(column.alias(name) for name, column in parents.items()),
    )
    several = reduce(lambda a, b: a | b, (F.min(p) != F.max(p) for p in parents))
    family, genus, gf = F.col(FAMILY), F.col(GENUS), F.col("gf")
    return (
        rows.groupingSets([[family, genus, gf], [genus, gf], [family, gf]], family, genus, gf)
        .agg(
            F.grouping_id().alias("level"),
            F.sum("obs").alias("obs"),
            F.sum("votes").alias("votes"),
            F.bit_or("in_genus").alias("in_genus"),
            F.bit_or("in_family").alias("in_family"),
            several.alias("several"),
        )
        .filter((F.col("level") == _FAMILY_LEVEL) | F.col(GENUS).isNotNull())
        .filter((F.col("level") != _ANY_LEVEL) | F.col("several"))
        .drop("several")
    )


#: Bits of the names that a level of the roll-up leaves out: label, genus, family.
_GENUS_LEVEL, _FAMILY_LEVEL, _ANY_LEVEL = 0b000, 0b010, 0b100


def genus_votes(rolled: DataFrame) -> DataFrame:
    """What :func:`genus_obs` gives, from a roll-up.

    Only genera with several families, which are few, need a second look at
    the ranks seen in all of them.
    """
    own = rolled.filter(F.col("level") == _GENUS_LEVEL).drop("level")
    other = rolled.filter(F.col("level") == _ANY_LEVEL).select(
        F.col(GENUS).alias("__genus"), F.col("gf").alias("__gf"), F.col("in_genus").alias("__tags")
    )
    same = (F.col(GENUS) == F.col("__genus")) & F.col("gf").eqNullSafe(F.col("__gf"))
    joined = own.join(other, same, "left")
    tags = F.coalesce("__tags", "in_genus")
    return joined.select(FAMILY, GENUS, "gf", _in_ranks(tags), "obs")


def family_votes(rolled: DataFrame) -> DataFrame:
    """What :func:`family_obs` gives, from a roll-up."""
    own = rolled.filter(F.col("level") == _FAMILY_LEVEL)
    return own.select(FAMILY, "gf", _in_ranks(F.col("in_family")), F.col("votes").alias("obs"))

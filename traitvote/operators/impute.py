"""Labels for a list of species, falling back to genus and family."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import FAMILY, GENUS, METHODS, RANKS, SPECIES
from ..functions import first_word
from ..sources import Keyed
from .names import ACCEPTED, ORIGINAL
from .synonyms import one_name_per_synonym

LABEL_COLUMNS = ["gf", "gf_conf", "gf_conf_flag", "gf_method"]


def _label_of(cons: DataFrame, rank: str) -> DataFrame:
    """One struct of label columns per taxon, under names no list will have."""
    label = F.struct(
        F.col("gf_cons").alias("gf"),
        "gf_conf",
        "gf_conf_flag",
        F.lit(METHODS[rank]).alias("gf_method"),
    )
    return cons.select(F.col(rank).alias(f"__{rank}_key"), label.alias(f"__{rank}"))


def _cascade(
    df: DataFrame, consensus: Mapping[str, DataFrame], keys: Mapping[str, str]
) -> tuple[DataFrame, Column]:
    """Join the consensus tables on; the column picks the finest label found.

    If none of the matched taxa has a label, the coarsest match is reported.
    """
    for rank, key in keys.items():
        df = df.join(_label_of(consensus[rank], rank), F.col(key) == F.col(f"__{rank}_key"), "left")
    finest_first = [F.col(f"__{rank}") for rank in keys]
    found = F.coalesce(
        *(F.when(label["gf"].isNotNull(), label) for label in finest_first),
        *reversed(finest_first),
    )
    return df, found


def with_genus(df: DataFrame) -> DataFrame:
    """Set ``genus`` to the first word of the species name."""
    return df.withColumn(GENUS, first_word(F.col(SPECIES)))


def impute(
    species_list: DataFrame,
    species: DataFrame,
    genus: DataFrame | None = None,
    family: DataFrame | None = None,
) -> DataFrame:
    """Label every row of a list with ``family`` and ``species``.

    The species' own label comes first, then its genus' and then its
    family's; each is looked up by that one name. Rows are neither lost nor
    multiplied. Label columns the list already has are replaced, as is
    ``genus``. Without ``genus`` and ``family`` only direct labels are given.

    Pass written tables for a long list: Spark then knows whether they are
    short enough to broadcast, and if not, splits a species that fills much
    of the list. It cannot do either for a consensus still to be computed.
    """
    consensus = {
        rank: table
        for rank, table in ((SPECIES, species), (GENUS, genus), (FAMILY, family))
        if table is not None
    }
    rows = with_genus(species_list.drop(*LABEL_COLUMNS))
    joined, found = _cascade(rows, consensus, {rank: rank for rank in consensus})
    return joined.select(*rows.columns, *(found[c].alias(c) for c in LABEL_COLUMNS))


def impute_keyed(
    species_list: Keyed,
    species: DataFrame,
    genus: DataFrame | None = None,
    family: DataFrame | None = None,
) -> DataFrame:
    """:func:`impute` for a list so long that it should be shuffled only once.

    ``species_list`` is keyed by ``species``, and ``species`` is a consensus in as many
    buckets (``Stages.write_bucketed``), so the two are joined where they lie,
    list after list. Rows of hot species meet a table of just these.
    """
    hot = species.join(species_list.hot, species[SPECIES] == F.col("__hot"), "left_semi")
    parts = (
        impute(rows, known, genus, family)
        for rows, known in ((species_list.rows, species), (species_list.apart, hot))
    )
    return reduce(DataFrame.unionByName, parts)


def resolve_synonyms(
    df: DataFrame, synonyms: DataFrame, write: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Add the accepted names of listed synonyms and ``name_updated`` 1.

    Rows whose names are no synonym get NULL in all four columns. ``write``
    writes the distinct synonyms before the join, as ``Stages.keep`` does.
    """
    df = df.drop("name_updated", *ACCEPTED)
    lines = one_name_per_synonym(synonyms).select(
        *(F.col(f"{r}_orig").alias(f"__{r}") for r in RANKS),
        F.lit(1).alias("name_updated"),
        *(F.col(r).alias(f"acc_{r}") for r in RANKS),
    )
    lines = write(lines) if write else lines
    same = [F.col(r) == F.col(f"__{r}") for r in RANKS]
    return df.join(lines, same, "left").drop(*(f"__{r}" for r in RANKS))


def label_synonyms(
    synonyms: DataFrame, species: DataFrame, genus: DataFrame, family: DataFrame
) -> DataFrame:
    """One line per original name with its accepted names and their label."""
    lines = one_name_per_synonym(synonyms).select(
        *ORIGINAL, *(F.col(r).alias(f"acc_{r}") for r in RANKS)
    )
    joined, found = _cascade(
        lines,
        {SPECIES: species, GENUS: genus, FAMILY: family},
        {rank: f"acc_{rank}" for rank in (SPECIES, GENUS, FAMILY)},
    )
    return joined.select(*lines.columns, *(found[c].alias(c) for c in LABEL_COLUMNS))


def relabel_synonyms(imputed: DataFrame, labelled: DataFrame) -> DataFrame:
    """Replace the labels of synonyms by those of :func:`label_synonyms`.

    A synonym whose accepted names match nothing loses its label. Rows that
    are no synonym keep theirs and a NULL ``name_updated``.
    """
    label = F.struct(*LABEL_COLUMNS).alias("__label")
    lines = labelled.select(
        *(F.col(f"{r}_orig").alias(f"__{r}") for r in RANKS), *ACCEPTED, label
    )
    rows = imputed.drop("name_updated", *ACCEPTED)
    same = [F.col(r) == F.col(f"__{r}") for r in RANKS]
    found = F.col("__label")
    written = {c: F.when(found.isNull(), F.col(c)).otherwise(found[c]) for c in LABEL_COLUMNS}
    written["name_updated"] = F.when(found.isNotNull(), 1)
    joined = rows.join(lines, same, "left").withColumns(written)
    return joined.drop("__label", *(f"__{r}" for r in RANKS))


def impute_synonyms(
    imputed: DataFrame,
    synonyms: DataFrame,
    species: DataFrame,
    genus: DataFrame,
    family: DataFrame,
) -> DataFrame:
    """Relabel the synonyms of an imputed list under their accepted names.

    The cascade runs on the table of synonyms, and the list is joined to its
    outcome once: joined rank by rank, every row that is no synonym would
    meet in the one partition of the NULL key.
    """
    return relabel_synonyms(imputed, label_synonyms(synonyms, species, genus, family))

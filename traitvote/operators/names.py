"""Correction of names by rules, keeping the original ones beside them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import FAMILY, GENUS, RANKS, SPECIES

ACCEPTED = tuple(f"acc_{rank}" for rank in RANKS)
ORIGINAL = tuple(f"{rank}_orig" for rank in RANKS)

# What the rules of each scope are matched on, weakest scope first: where
# several rules write the same name, the later scope wins. One join serves
# the scopes with equal keys.
SCOPES = {
    (GENUS, FAMILY): ("genus_family", "genus_family_null_species"),
    (SPECIES, FAMILY): ("species_family",),
    (SPECIES,): ("species",),
}
_WEAKEST_FIRST = tuple(scope for scopes in SCOPES.values() for scope in scopes)


def _rule(scope: str) -> str:
    return f"__rule_{scope}"


#: Writes a short table and returns what was written, as ``Stages.keep`` does.
Write = Callable[[DataFrame], DataFrame]


def _match(df: DataFrame, rules: DataFrame, write: Write | None = None) -> DataFrame:
    """Add the rule of every scope that fits a row, as a struct or NULL.

    With ``write`` the distinct rules are written before they are joined, so
    that Spark can split the rows of a name that fills much of the table.
    """
    effect = F.struct(
        *(c for rank in RANKS for c in (f"set_{rank}", f"acc_{rank}")), "copy_species", "track"
    )
    for keys, scopes in SCOPES.items():
        best = (
            rules.filter(F.col("scope").isin(*scopes))
            .groupBy(*(F.col(k).alias(f"__{k}") for k in keys))
            .agg(*(F.min(F.when(F.col("scope") == s, effect)).alias(_rule(s)) for s in scopes))
        )
        best = write(best) if write else best
        same = [F.col(k) == F.col(f"__{k}") for k in keys]
        df = df.join(best, same, "left").drop(*(f"__{k}" for k in keys))
    only_without_species = _rule("genus_family_null_species")
    return df.withColumn(
        only_without_species, F.when(F.col(SPECIES).isNull(), F.col(only_without_species))
    )


def _written(rank: str, current: Column) -> Column:
    """The value of one name after all matched rules."""

    def write(value: Column, scope: str) -> Column:
        rule = F.col(_rule(scope))
        new = rule[f"acc_{rank}"]
        if rank == SPECIES:
            new = F.when(rule["copy_species"], F.col(SPECIES)).otherwise(new)
        return F.when(rule[f"set_{rank}"], new).otherwise(value)

    return reduce(write, _WEAKEST_FIRST, current)


def accepted_names(review: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``acc_family, acc_genus, acc_species`` to a review table.

    Names that no rule writes stay NULL: a flagged name without a rule is
    given up, not kept.
    """
    nothing = F.lit(None).cast("string")
    accepted = {f"acc_{rank}": _written(rank, nothing) for rank in RANKS}
    return _match(review, rules).withColumns(accepted).drop(*map(_rule, _WEAKEST_FIRST))


def with_original_names(df: DataFrame) -> DataFrame:
    """Keep the names as they came in ``*_orig`` and set ``name_updated`` to 0."""
    return df.withColumns(
        {f"{rank}_orig": F.col(rank) for rank in RANKS}
        | {"name_updated": F.lit(0).cast("smallint")}
    )


def fix_names(df: DataFrame, rules: DataFrame, write: Write | None = None) -> DataFrame:
    """Overwrite names directly by rules, before any homonym is looked for.

    Only rules with ``track`` set ``name_updated``. With ``write`` the distinct
    rules of each scope are written before they are joined.
    """
    tracks = (F.col(_rule(scope))["track"].cast("smallint") for scope in _WEAKEST_FIRST)
    tracked = F.coalesce(F.greatest(*tracks), F.lit(0))
    written = {rank: _written(rank, F.col(rank)) for rank in RANKS}
    written["name_updated"] = F.greatest("name_updated", tracked).cast("smallint")
    return _match(df, rules, write).withColumns(written).drop(*map(_rule, _WEAKEST_FIRST))


def correct_names(
    df: DataFrame, review: DataFrame, genus_rule_scope: str = "all", write: Write | None = None
) -> DataFrame:
    """Replace the original names of flagged rows by the accepted ones.

    ``df`` comes from :func:`with_original_names`, ``review`` from
    :func:`accepted_names`. Rows are matched on all three original names; a
    review line without a species then rewrites *every* row of its (family,
    genus), also those already matched, and clears their species. Pass
    ``genus_rule_scope="null_species_only"`` to leave rows with a species to
    their own line. ``write`` is used as in :func:`fix_names`, for the distinct
    lines of the review.
    """
    if genus_rule_scope not in ("all", "null_species_only"):
        raise ValueError(f"unknown genus_rule_scope {genus_rule_scope!r}")

    def lines(kind: str, with_species: bool) -> DataFrame:
        keys = RANKS if with_species else (FAMILY, GENUS)
        has_species = F.col(SPECIES).isNotNull()
        return (
            review.filter(has_species if with_species else ~has_species)
            .groupBy(*(F.col(k).alias(f"{kind}_{k}") for k in keys))
            .agg(F.min(F.struct(*ACCEPTED)).alias(kind))
        )

    by_species, by_genus = lines("__s", True), lines("__g", False)
    if write:
        by_species, by_genus = write(by_species), write(by_genus)
    same_species = [F.col(f"{r}_orig") == F.col(f"__s_{r}") for r in RANKS]
    same_genus = [F.col(f"{r}_orig") == F.col(f"__g_{r}") for r in (FAMILY, GENUS)]
    if genus_rule_scope == "null_species_only":
        same_genus.append(F.col(f"{SPECIES}_orig").isNull())

    s, g = F.col("__s"), F.col("__g")
    cleared = F.lit(None).cast("string")
    written = {
        rank: F.when(g.isNotNull(), cleared if rank == SPECIES else g[f"acc_{rank}"])
        .when(s.isNotNull(), s[f"acc_{rank}"])
        .otherwise(F.col(rank))
        for rank in RANKS
    }
    written["name_updated"] = F.when(
        g.isNotNull() | s.isNotNull(), F.lit(1).cast("smallint")
    ).otherwise(F.col("name_updated"))
    joined = df.join(by_species, same_species, "left").join(by_genus, same_genus, "left")
    return joined.withColumns(written).drop(*by_species.columns, *by_genus.columns)


def name_changes(df: DataFrame, *then_by: str) -> DataFrame:
    """Rows whose names were changed, by original name.

    Columns that tell rows of one name apart, such as an id, let Spark spread
    the sort of a name with very many rows.
    """
    changed = df.filter("name_updated = 1").orderBy(*ORIGINAL, *then_by)
    return changed.select(*ORIGINAL, *RANKS)

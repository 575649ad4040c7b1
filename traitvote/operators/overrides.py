"""Curated corrections of the vote."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import FAMILY


def with_notes(cons: DataFrame) -> DataFrame:
    """The table with a ``notes`` column, empty if it had none."""
    if "notes" in cons.columns:
        return cons
    return cons.withColumn("notes", F.lit(None).cast("string"))


def apply_overrides(cons: DataFrame, overrides: DataFrame) -> DataFrame:
    """Overwrite the consensus of listed families, column by column.

    A NULL leaves the voted value. ``total_obs`` is never refreshed.
    """
    cons = with_notes(cons)
    fields = ["gf_cons", "gf_all", "gf_cons_obs", "gf_cons_prop", "notes"]
    listed = overrides.groupBy(F.col(FAMILY).alias("__family")).agg(
        *(F.max(c).alias(f"__{c}") for c in fields),
        F.bool_or("clear_inferred_from_ranks").alias("__clear"),
    )
    types = dict(cons.dtypes)
    written = {c: F.coalesce(F.col(f"__{c}").cast(types[c]), F.col(c)) for c in fields}
    if "inferred_from_ranks" in cons.columns:
        written["inferred_from_ranks"] = F.when(
            ~F.coalesce("__clear", F.lit(False)), F.col("inferred_from_ranks")
        )
    joined = cons.join(listed, F.col(FAMILY) == F.col("__family"), "left")
    return joined.withColumns(written).drop(*listed.columns)


def exclude_groups(cons: DataFrame, families: DataFrame) -> DataFrame:
    """Drop the taxa of families that are labelled at the family rank only."""
    return cons.join(families.select(FAMILY), FAMILY, "left_anti")

"""The table of changed names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..constants import RANKS
from .names import ORIGINAL


def synonym_table(*corrected: DataFrame) -> DataFrame:
    """Distinct (accepted names, original names) of all changed rows."""
    changed = [
        df.filter("name_updated = 1").select(*RANKS, *ORIGINAL).distinct() for df in corrected
    ]
    return reduce(DataFrame.unionByName, changed).distinct()


def one_name_per_synonym(synonyms: DataFrame) -> DataFrame:
    """Keep one accepted name per original one.

    Sources may correct a name differently; the line with a species comes
    first, then the lowest family, genus and species.
    """
    accepted = F.struct(
        F.col("species").isNull().alias("no_species"),
        *(part for r in RANKS for part in (F.col(r).isNull().alias(f"no_{r}_name"), r)),
    )
    first = F.col("__first")
    return (
        synonyms.groupBy(*ORIGINAL)
        .agg(F.min(accepted).alias("__first"))
        .select(*(first[r].alias(r) for r in RANKS), *ORIGINAL)
    )

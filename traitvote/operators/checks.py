"""Data-quality checks, each a one-row DataFrame of booleans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import GENUS, SPECIES
from .clean import rank_of, with_rank
from .homonyms import homonym_names


def check_rank_assigned(df: DataFrame) -> DataFrame:
    """True if every row names a taxon at some rank."""
    missing = F.count_if(F.col("applies_to_rank").isNull())
    return with_rank(df).agg((missing == 0).alias("applies_to_rank_not_null"))


def row_metrics() -> dict[str, Column]:
    """What is to be observed of counted rows while they are written.

    ``rows`` and the ``records`` they stand for, and ``unplaced``: rows that name
    no taxon, of which there should be none.
    """
    return {
        "rows": F.count(F.lit(1)),
        "records": F.coalesce(F.sum("n"), F.lit(0)),
        "unplaced": F.count_if(rank_of().isNull()),
    }


def check_parent(df: DataFrame, child: str, parent: str = "family") -> DataFrame:
    """True if some ``child`` has more than one ``parent`` (it should not)."""
    names = homonym_names(df, child, parent)
    return names.agg((F.count(F.lit(1)) > 0).alias(f"has_homonym_{child}"))


def check_all(df: DataFrame) -> DataFrame:
    """All checks of a set of attributions, one row ``check, value`` each.

    Names repeat in records, so pass counted rows where there are any.
    """
    results = [check_rank_assigned(df), check_parent(df, SPECIES), check_parent(df, GENUS)]
    named = [
        r.select(F.lit(r.columns[0]).alias("check"), F.col(r.columns[0]).alias("value"))
        for r in results
    ]
    return reduce(DataFrame.unionByName, named)


def assert_ok(check: DataFrame, expected: bool) -> None:
    """Raise if the one value of ``check`` is not ``expected``."""
    name = check.columns[0]
    value = check.first()[name]
    if value is not expected:
        raise ValueError(f"check {name} gave {value}, expected {expected}")

"""Ordered pages of a result for the eye."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources import Stages, write_ordered


def inspect_page(
    df: DataFrame,
    *order: Column | str,
    limit: int = 25,
    offset: int = 0,
    stages: Stages | None = None,
) -> DataFrame:
    """``limit`` rows from ``offset`` on, in the given order, or any without one.

    Near the front that is cheap. For pages far down give ``stages``: the rows are
    then written in order, and only the partitions that hold the page are read,
    so no task sees more than one of them. ``write_ordered`` does the first part
    once for all pages of a result.
    """
    if stages is not None:
        return write_ordered(df, *order, stages=stages, name="pages").page(limit, offset)
    ordered = df.orderBy(*order) if order else df
    return ordered.offset(offset).limit(limit)


def epithet() -> Column:
    """Second word of a species name, the usual order of a page."""
    return F.split_part(F.col("species"), F.lit(" "), F.lit(2))

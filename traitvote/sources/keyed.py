"""Tables kept by the key they are joined on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from .stages import Stages

#: Rows of one key that are held apart.
HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class Keyed:
    """A long table, dealt to ``buckets`` by ``key`` once and for all its joins.

    A bucket is read by one task, so rows of hot keys and rows without a key
    are not among ``rows`` but in ``apart``, a plain table; ``hot`` lists these
    keys, each with very many rows, so they are few.
    """

    rows: DataFrame
    apart: DataFrame
    hot: DataFrame
    key: str
    buckets: int


def write_keyed(
    df: DataFrame, key: str, buckets: int, stages: Stages, name: str, hot_rows: int = HOT_ROWS
) -> Keyed:
    """Write a table to be joined on ``key``, which may repeat or be NULL."""
    name = stages.fresh(name)
    written = stages.write(f"{name}_unkeyed", df)
    many = written.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    many = many.filter((F.col("__n") > hot_rows) & F.col(key).isNotNull())
    hot = stages.write(f"{name}_hot", many.select(F.col(key).alias("__hot")))
    is_hot = written[key] == hot["__hot"]
    rows = written.filter(F.col(key).isNotNull()).join(hot, is_hot, "left_anti")
    apart = written.filter(F.col(key).isNull()).unionByName(written.join(hot, is_hot, "left_semi"))
    return Keyed(
        stages.write_bucketed(f"{name}_keyed", rows, key, buckets),
        stages.write(f"{name}_apart", apart),
        hot,
        key,
        buckets,
    )

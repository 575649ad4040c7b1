"""Tables written in an order, for places and sums along it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .sizes import tasks_for
from .stages import Stages

PART, PLACE = "__part", "__place"
_OWN = (1 << 33) - 1


@dataclass(frozen=True)
class Ordered:
    """A table dealt to partitions by ranges of an order, and sorted in each.

    ``rows`` has two further columns: the number of the partition a row is in,
    which is also the folder it is written to, and the row's place there from
    0. ``parts`` has a row for each partition: its number, how many rows it has
    (``n``) and how many there are in those before (``before``).
    """

    rows: DataFrame
    parts: DataFrame

    def page(self, limit: int, offset: int = 0) -> DataFrame:
        """``limit`` rows from ``offset`` on, in order.

        Only the partitions that hold them are read, and only what is on the
        page goes on. A page beyond the end is empty.
        """
        last = offset + limit
        found = self.parts.filter((F.col("before") < last) & (F.col("before") + F.col("n") > offset))
        before = {row[PART]: row["before"] for row in found.collect()}  # at most one a row of the page
        wanted = F.lit(False)
        for part, start in before.items():
            wanted = wanted | (
                (F.col(PART) == part) & F.col(PLACE).between(offset - start, last - 1 - start)
            )
        rows = self.rows.filter(F.col(PART).isin(*before)).filter(wanted)
        return rows.orderBy(PART, PLACE).drop(PART, PLACE)

    def numbered(self, name: str) -> DataFrame:
        """The rows with their place over all partitions, from 0."""
        joined = self.rows.join(self.parts.select(PART, "before"), PART)
        return joined.withColumn(name, F.col("before") + F.col(PLACE)).drop(PART, PLACE, "before")

    def running(self, **sums: Column | str) -> DataFrame:
        """The rows with sums over all rows up to and with themselves."""
        named = {f"__{name}": F.col(c) if isinstance(c, str) else c for name, c in sums.items()}
        rows = self.rows.withColumns(named)
        whole = rows.groupBy(PART).agg(*(F.sum(c).alias(c) for c in named))
        # one row for each partition
        earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        starts = whole.select(PART, *(F.sum(c).over(earlier).alias(f"{c}_before") for c in named))
        inside = Window.partitionBy(PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
        made = rows.withColumns({f"{c}_inside": F.sum(c).over(inside) for c in named}).join(starts, PART)
        result = {n: F.coalesce(f"__{n}_before", F.lit(0)) + F.col(f"__{n}_inside") for n in sums}
        return made.withColumns(result).drop(
            PART, PLACE, *named, *(f"{c}_{k}" for c in named for k in ("before", "inside"))
        )


def write_ordered(df: DataFrame, *order: Column | str, stages: Stages, name: str) -> Ordered:
    """Write ``df`` in ``order``; rows equal in it come in no particular order.

    The rows are written before they are sorted, so that what deals them out
    sees the same rows each time. Many rows with equal keys still spread, and
    more rows get more partitions.
    """
    name = stages.fresh(name)
    unordered = stages.write(f"{name}_unordered", df)
    tasks = tasks_for(df.sparkSession, unordered.count())
    tied = unordered.withColumn("__tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*([tasks] if tasks else []), *order, "__tie")
    dealt = dealt.sortWithinPartitions(*order, "__tie").drop("__tie")
    own = F.monotonically_increasing_id()
    placed = dealt.withColumns({PART: F.shiftright(own, 33), PLACE: own.bitwiseAND(F.lit(_OWN))})
    rows = stages.write(f"{name}_ordered", placed, PART)
    sizes = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))
    parts = sizes.withColumn("before", F.coalesce(before, F.lit(0)))  # one row for each partition
    return Ordered(rows, stages.write(f"{name}_parts", parts))

"""Mix sources to target weights by iterative proportional fitting.

Documents are counted to cells, one for each combination of the dimensions.
The token weights of the cells are raked to the targets of one dimension after
the other until all marginals agree. A document is then kept with a
probability in proportion to its cell's weight, calibrated so that the expected
number of tokens meets a budget. Everything after the count works on cells.
"""

from __future__ import annotations

import itertools
import warnings
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources import Stages, write_ordered
from .common import WORD

#: Marginals count as settled when none moves by more than this share of the
#: tolerance in a round; targets they then miss contradict each other.
SETTLED = 1e-3
#: Cells that one task can rake by itself (some 100 bytes each).
FOLD_CELLS = 20_000
#: Rounds of a job that rakes in one task; it ends early and is started again.
FOLD_ROUNDS = 2_000


def tokens_of(text_column: str) -> Column:
    """Words of a text; at least one, so that an empty text has a weight."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return F.greatest(F.regexp_count(text, F.lit(WORD)), F.lit(1)).cast("bigint")


def uniform(id_column: str, text_column: str, seed: str) -> Column:
    """A number in [0, 1) that only id, text without id, and seed decide."""
    key = F.coalesce(F.col(id_column).cast("string"), F.col(text_column), F.lit(""))
    hexadecimal = F.substring(F.md5(F.concat(F.lit(seed), key)), 1, 12)
    return F.conv(hexadecimal, 16, 10).cast("bigint") / F.lit(float(1 << 48))


def smoothed_target(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Targets in proportion to a power of what a value has: below 1, more even."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("tokens"))
    return sums.select("value", F.pow("tokens", F.lit(power)).alias("target"))


def _shares(targets: DataFrame, cells: DataFrame, dimension: str) -> DataFrame:
    """Targets of the values that occur, as shares of one."""
    present = cells.select(F.col(dimension).alias("value")).distinct()
    kept = targets.join(present, targets["value"].eqNullSafe(present["value"]), "left_semi")
    kept = kept.filter("target > 0")
    total = kept.agg(F.sum("target")).first()[0] or 1.0
    return kept.select("value", (F.col("target") / F.lit(total)).alias("target"))


def _step(
    cells: DataFrame,
    dimension: str,
    target: DataFrame,
    factors: Mapping[str, DataFrame],
) -> DataFrame:
    """The factors that meet one dimension's targets, and what they had met before.

    Returns ``value, factor, target, marginal``. Cells keep their tokens; the
    factors of all dimensions are joined to them, so a step reads each table
    once however many came before it.
    """
    others = {d: f for d, f in factors.items() if d != dimension}
    weighted = _weigh(cells, others)
    sums = weighted.groupBy(F.col(dimension).alias("__value")).agg(F.sum("weight").alias("__sum"))
    joined = sums.join(target, sums["__value"].eqNullSafe(target["value"]), "left").drop("value")
    last = F.lit(None).cast("double")
    if dimension in factors:
        old = factors[dimension].select(F.col("value").alias("__same"), F.col("factor").alias("__old"))
        joined = joined.join(old, joined["__value"].eqNullSafe(old["__same"]), "left")
        last = F.col("__sum") * F.col("__old")
    factor = F.when(F.col("__sum") > 0, F.col("target") / F.col("__sum"))
    return joined.select(
        F.col("__value").alias("value"),
        F.coalesce(factor, F.lit(0.0)).alias("factor"),
        "target",
        last.alias("marginal"),
    )


def _weigh(cells: DataFrame, factors: Mapping[str, DataFrame]) -> DataFrame:
    """Cells with ``weight``: tokens times the factor of each dimension."""
    columns, weight = cells.columns, F.col("tokens").cast("double")
    for k, (dimension, table) in enumerate(factors.items()):
        named = table.select(F.col("value").alias(f"__value{k}"), F.col("factor").alias(f"__factor{k}"))
        on = cells[dimension].eqNullSafe(named[f"__value{k}"])
        cells, weight = cells.join(named, on), weight * F.col(f"__factor{k}")
    return cells.select(*columns, weight.alias("weight"))


def _rounds(
    cells: DataFrame, shares: Mapping[str, DataFrame], stages: Stages, tolerance: float
) -> tuple[dict[str, DataFrame], float]:
    """Factors of each dimension, by tables that Spark joins, and the largest error."""
    factors: dict[str, DataFrame] = {}
    for k in itertools.count():
        earlier, missed = dict(factors), []
        for dimension, share in shares.items():
            step = _step(cells, dimension, share, factors)
            new = factors[dimension] = stages.write(f"factors_{dimension}_{k}", step)
            if k:
                old = earlier[dimension].select(F.col("value").alias("__same"), F.col("marginal").alias("__was"))
                both = new.join(old, new["value"].eqNullSafe(old["__same"]))
                both = both.filter("target > 0")
                now = F.coalesce("marginal", F.lit(0.0))
                missed.append(
                    both.select(
                        F.abs(now / F.col("target") - 1).alias("error"),
                        F.abs((now - F.coalesce("__was", F.lit(0.0))) / F.col("target")).alias("change"),
                    )
                )
        if k:
            worst = reduce(DataFrame.unionByName, missed).agg(F.max("error"), F.max("change")).first()
            error, change = worst[0] or 0.0, worst[1] or 0.0
            if error <= tolerance or change <= tolerance * SETTLED:
                return factors, error
    raise AssertionError


def _grouped(cells: DataFrame, shares: Mapping[str, DataFrame]) -> DataFrame:
    """One row ``dims``: for each dimension its values, with target and cells.

    A cell has its tokens and, in ``at``, the number of its value in each
    dimension; values are numbered in their order.
    """
    numbered = cells.coalesce(1)
    for k, dimension in enumerate(shares):
        place = F.dense_rank().over(Window.orderBy(F.col(dimension).asc_nulls_first())) - 1
        numbered = numbered.withColumn(f"__at{k}", place)
    at = F.array(*(F.col(f"__at{k}") for k in range(len(shares))))
    cell = F.struct(F.col("tokens").cast("double").alias("tokens"), at.alias("at"))
    made = []
    for k, (dimension, share) in enumerate(shares.items()):
        joined = numbered.join(share, numbered[dimension].eqNullSafe(share["value"]), "left")
        values = joined.groupBy(F.col(f"__at{k}").alias("number")).agg(
            F.coalesce(F.max("target"), F.lit(0.0)).alias("target"), F.collect_list(cell).alias("cells")
        )
        listed = F.sort_array(F.collect_list(F.struct("number", "target", "cells")))
        made.append(values.agg(F.lit(k).alias("k"), listed.alias("values")))
    rows = reduce(DataFrame.unionByName, made).agg(F.sort_array(F.collect_list(F.struct("k", "values"))).alias("dims"))
    return rows


def _turn(state: Column, dims: Column, number: Column, n_dims: int, tolerance: float) -> Column:
    """The state after one dimension's factors have been fitted to its targets."""
    d = number % n_dims
    values = F.get(dims, d)["values"]

    def weight(cell: Column) -> Column:
        product = cell["tokens"]
        for e in range(n_dims):
            factor = F.get(F.get(state["factors"], F.lit(e)), F.get(cell["at"], F.lit(e)))
            product = product * F.when(d == e, 1.0).otherwise(factor)
        return product

    def fitted(sums: Column) -> Column:
        factors = F.zip_with(
            values, sums, lambda v, s: F.when(s > 0, v["target"] / s).otherwise(0.0)
        )
        marginals = F.zip_with(sums, F.get(state["factors"], d), lambda s, f: s * f)
        return F.struct(factors.alias("factors"), marginals.alias("marginals"))

    def largest(now: Column, then: Column | None) -> Column:
        ratios = F.zip_with(
            values, now, lambda v, m: F.when(v["target"] > 0, m / v["target"]).otherwise(1.0)
        )
        if then is None:
            return F.array_max(F.transform(ratios, lambda r: F.abs(r - 1)))
        before = F.zip_with(
            values, then, lambda v, m: F.when(v["target"] > 0, m / v["target"]).otherwise(1.0)
        )
        return F.array_max(F.zip_with(ratios, before, lambda r, b: F.abs(r - b)))

    def put(lists: Column, new: Column) -> Column:
        return F.transform(lists, lambda old, e: F.when(e == d, new).otherwise(old))

    def moved(made: Column) -> Column:
        begins, now = d == 0, made["marginals"]
        error = F.greatest(F.when(begins, 0.0).otherwise(state["error"]), largest(now, None))
        change = F.greatest(
            F.when(begins, 0.0).otherwise(state["change"]),
            largest(now, F.get(state["marginals"], d)),
        )
        return F.struct(
            put(state["factors"], made["factors"]).alias("factors"),
            put(state["marginals"], now).alias("marginals"),
            error.alias("error"),
            change.alias("change"),
            F.lit(False).alias("done"),
        )

    def judged(new: Column) -> Column:
        settled = (new["error"] <= tolerance) | (new["change"] <= tolerance * SETTLED)
        return new.withField("done", (d == n_dims - 1) & settled)

    sums = F.transform(
        values, lambda v: F.aggregate(v["cells"], F.lit(0.0), lambda total, c: total + weight(c))
    )
    # one-element arrays give what is used twice a name
    made = F.transform(F.array(sums), fitted)
    next_state = F.get(F.transform(F.transform(made, moved), judged), F.lit(0))
    return F.when(state["done"], state).otherwise(next_state)


def _fold(
    cells: DataFrame, shares: Mapping[str, DataFrame], stages: Stages, tolerance: float
) -> tuple[dict[str, DataFrame], float]:
    """The same for cells few enough for one task: whole runs of rounds in one job."""
    n_dims = len(shares)
    dims = stages.write("rake_cells", _grouped(cells, shares))

    def lists(value: float) -> Column:
        return F.transform("dims", lambda d: F.transform(d["values"], lambda _: F.lit(value)))

    state = F.struct(
        lists(1.0).alias("factors"),
        lists(0.0).alias("marginals"),
        F.lit(0.0).alias("error"),
        F.lit(0.0).alias("change"),
        F.lit(False).alias("done"),
    )
    rows = dims.withColumn("state", state)
    turns = F.sequence(F.lit(0), F.lit(FOLD_ROUNDS * n_dims - 1))
    for k in itertools.count():
        folded = F.aggregate(
            turns, F.col("state"), lambda s, i: _turn(s, F.col("dims"), i, n_dims, tolerance)
        )
        rows = stages.write(f"raked_{k}", rows.withColumn("state", folded))
        done = rows.select("state.done", "state.error").first()
        if done["done"]:
            break
    factors = {}
    for k, dimension in enumerate(shares):
        found = rows.select(F.posexplode(F.get("state.factors", F.lit(k))).alias("__number", "factor"))
        place = F.dense_rank().over(Window.orderBy(F.col("value").asc_nulls_first())) - 1
        values = cells.select(F.col(dimension).alias("value")).distinct().coalesce(1).withColumn("__number", place)
        factors[dimension] = values.join(found, "__number").select("value", "factor")
    return stages.write_all({f"factors_{d}": f for d, f in factors.items()}), done["error"]


def rake(
    cells: DataFrame,
    targets: Mapping[str, DataFrame],
    stages: Stages,
    tolerance: float = 1e-7,
) -> DataFrame:
    """Cells with ``weight``: shares of one whose marginals meet the targets.

    ``cells`` has the dimensions and ``tokens``; ``targets`` has for each
    dimension a table ``value, target``. Values without a target get no
    weight; targets of values that do not occur are left out, the others are
    scaled to one. A NULL value is a value like any other.

    Rounds go on until every marginal is within ``tolerance`` of its target, as
    a share of it. Targets that contradict each other cannot be met: their
    weights are the ones the rounds settle on, when no marginal moves by more
    than a thousandth of ``tolerance`` any more, so they follow from the data; the
    last dimension's targets are then met, and a warning tells by how much
    others are missed. Up to ``FOLD_CELLS`` cells, many rounds are one job.
    """
    shares = {d: _shares(t, cells, d) for d, t in targets.items()}
    written = stages.write_all({f"target_{d}": share for d, share in shares.items()})
    shares = {d: written[f"target_{d}"] for d in targets}
    if not shares or cells.isEmpty():
        return cells.withColumn("weight", F.col("tokens").cast("double"))
    if cells.count() <= FOLD_CELLS:
        found, error = _fold(cells, shares, stages, tolerance)
        factors = {d: found[f"factors_{d}"] for d in shares}
    else:
        factors, error = _rounds(cells, shares, stages, tolerance)
    if error > tolerance:
        warnings.warn(
            f"targets cannot be met: a marginal misses its target by {error:.2g} of it", stacklevel=2
        )
    return _weigh(cells, factors)


def calibrate(cells: DataFrame, budget: float, stages: Stages) -> DataFrame:
    """Add ``probability``: the share of a cell's documents to keep.

    Proportional to weight over tokens, at most one. What capped cells cannot
    give is made up for by the others, so the expected tokens meet ``budget``
    or, at the most, all there are in cells with a weight. Cells are ordered by
    their ratio; running sums tell for each of them the scale at which it and
    all below it use up what those above, kept whole, leave of the budget. The
    highest cell that its own scale does not cap decides.
    """
    ratio = F.coalesce(F.col("weight") / F.col("tokens"), F.lit(0.0))
    ordered = write_ordered(
        cells.withColumn("__ratio", ratio), "__ratio", stages=stages, name="by_ratio"
    )
    sums = ordered.running(__below="tokens", __share="weight")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    scale = (F.lit(float(budget)) - (F.lit(total) - F.col("__below"))) / F.col("__share")
    free = sums.filter("__share > 0").withColumn("__scale", scale).filter("__ratio * __scale < 1")
    chosen = free.agg(F.max(F.struct("__ratio", "__below", "__scale"))["__scale"]).first()[0]
    probability = F.when(ratio > 0, 1.0).otherwise(0.0)
    if chosen is not None:
        probability = F.least(F.lit(1.0), F.greatest(F.lit(0.0), ratio * F.lit(chosen)))
    return cells.withColumn("probability", probability)


def mix(
    docs: DataFrame,
    dimensions: Mapping[str, Column],
    stages: Stages,
    targets: Mapping[str, DataFrame] | None = None,
    power: float = 0.5,
    keep: float = 0.5,
    seed: str = "mix",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """All rows with ``n_tokens, probability, kept``.

    ``dimensions`` names the expressions to balance, such as source, language
    and topic. Without ``targets`` each dimension is evened out by ``power``.
    ``keep`` is the budget as a share of all tokens. A row is kept where a
    hash of its id falls below its probability; repeated rows fall together.
    All columns stay; the new ones replace columns of the same name.
    """
    own = {f"__{name}": column for name, column in dimensions.items()}
    rows = docs.withColumns(own).withColumn("__tokens", tokens_of(text_column))
    cells = stages.write(
        "cells", rows.groupBy(*own).agg(F.sum("__tokens").alias("tokens"))
    )
    wanted = {
        d: targets[d[2:]] if targets else smoothed_target(cells, d, power) for d in own
    }
    raked = stages.write("raked", rake(cells, wanted, stages))
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    chosen = stages.write("probabilities", calibrate(raked, keep * total, stages))
    on = [rows[d].eqNullSafe(chosen[d]) for d in own]
    joined = rows.join(chosen.select(*own, F.col("probability").alias("__probability")), on, "left")
    found = F.coalesce(F.col("__probability"), F.lit(0.0))
    names = dict.fromkeys([*docs.columns, "n_tokens", "probability", "kept"])
    return joined.withColumns(
        {
            "n_tokens": F.col("__tokens"),
            "probability": found,
            "kept": uniform(id_column, text_column, seed) < found,
        }
    ).select(*names)


def topic_of(text_column: str) -> Column:
    """A coarse topic from the form of the text: table, symbols, shout, prose."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    length = F.length(text)
    return (
        F.when(F.regexp_count(text, F.lit(r"\|")) * 50 > length, "table")
        .when(F.regexp_count(text, F.lit(r"[#*$%&]")) * 20 > length, "symbols")
        .when(F.regexp_count(text, F.lit("[A-Z]")) * 4 > length, "shout")
        .otherwise("prose")
    )

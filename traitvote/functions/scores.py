"""Shares, penalties and confidence, in exact decimals.

Spark casts a decimal to fewer digits by rounding half away from zero, which
is the rounding these scores are defined with. Doubles would round a few
ties the other way, so no score passes through one.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, functions as F

from ..constants import CONFIDENCE_FLAGS, CONFIDENCE_FLOOR_FLAG

Number = int | float | str | Decimal


def _exact(value: Number) -> Decimal:
    return Decimal(str(value))


def _whole(count: Column) -> Column:
    return count.cast("decimal(18,0)")


def share(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole`` rounded to ``digits``."""
    return (_whole(part) / _whole(whole)).cast(f"decimal({digits + 3},{digits})")


def low_n_penalty(total: Column, pthresh: Number = 100, pdenom: Number = 5) -> Column:
    """``-(1 - least(total, pthresh) / 100) / pdenom``, two digits.

    The 100 is fixed: a ``pthresh`` below it leaves a penalty however many
    records there are, one above it turns into a bonus. A NULL total counts
    as ``pthresh``.
    """
    n = F.least(_whole(total), F.lit(_exact(pthresh)))
    return ((n - 100) / F.lit(_exact(pdenom) * 100)).cast("decimal(3,2)")


def coverage_ratio(assessed: Column, listed: Column) -> Column:
    """Share of the listed species that have a label; NULL if none is listed."""
    return F.when(listed > 0, assessed / listed)


def coverage_penalty(
    assessed: Column, listed: Column, pmax: Number = 0.2, clamp: bool = False
) -> Column:
    """``-(1 - assessed / listed) * pmax``, two digits; NULL if none is listed.

    More assessed than listed species make it a bonus, and a bonus of ten or
    more fails the cast. ``clamp`` holds the ratio at one.
    """
    if clamp:
        assessed = F.least(assessed, listed)
    lack = (_whole(assessed) - _whole(listed)) * F.lit(_exact(pmax))
    return F.when(listed > 0, lack / _whole(listed)).cast("decimal(3,2)")


def confidence_score(share: Column, *penalties: Column) -> Column:
    """Share plus penalties, at least 0; a NULL penalty gives 0."""
    total = share
    for penalty in penalties:
        total = total + penalty
    return F.greatest(total, F.lit(Decimal(0))).cast("decimal(3,2)")


def confidence_flag(
    score: Column,
    flags: Mapping[str, Decimal] = CONFIDENCE_FLAGS,
    floor: str = CONFIDENCE_FLOOR_FLAG,
) -> Column:
    """Category of a score; NULL for a NULL score."""
    category = F.when(score.isNotNull(), floor)
    for name, bound in sorted(flags.items(), key=lambda item: item[1]):
        category = F.when(score >= bound, name).otherwise(category)
    return category

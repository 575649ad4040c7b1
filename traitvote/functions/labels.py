"""Text expressions for labels and names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from ..constants import LABEL_PRIORITY


def clean_label(label: Column, strip: Iterable[str] = ("*",)) -> Column:
    """Lower-case, remove every ``strip`` string, trim spaces, blank to NULL."""
    label = F.lower(label)
    for text in strip:
        label = F.replace(label, F.lit(text), F.lit(""))
    return F.nullif(F.trim(label), F.lit(""))


def blank_to_null(value: Column) -> Column:
    """NULL for a value of spaces only; any other value keeps its spaces."""
    return F.when(F.trim(value) != "", value)


def first_word(name: Column) -> Column:
    """The genus of a species name: the text before the first space."""
    return F.split_part(name, F.lit(" "), F.lit(1))


def label_priority(label: Column, priority: Mapping[str, int] = LABEL_PRIORITY) -> Column:
    """Rank of a label in a tied vote: 0 if not listed, NULL for a NULL label."""
    rank = F.lit(0)
    for name, value in reversed(priority.items()):
        rank = F.when(label == name, value).otherwise(rank)
    return F.when(label.isNotNull(), rank).cast("smallint")

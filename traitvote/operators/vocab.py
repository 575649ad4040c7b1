"""The vocabulary: verbatim labels and what a person made of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..functions import blank_to_null
from ..schemas import VOCABULARY


def verbatim_vocab(df: DataFrame, label: str = "label") -> DataFrame:
    """Distinct labels with the empty columns a person fills in."""
    empty = {f.name: F.lit(None).cast(f.dataType) for f in VOCABULARY}
    empty["is_useless"] = F.lit(0).cast("smallint")
    return (
        df.select(F.col(label).alias("gf_verbatim"))
        .distinct()
        .select("gf_verbatim", *(empty[f.name].alias(f.name) for f in VOCABULARY[1:]))
    )


def meanings(vocab: DataFrame) -> DataFrame:
    """One meaning for each listed label; one listed twice counts once."""
    meaning = F.struct(*(f.name for f in VOCABULARY[1:]))
    return vocab.groupBy(F.col("gf_verbatim").alias("__key")).agg(
        F.min(meaning).alias("__meaning")
    )


def apply_vocab(
    df: DataFrame,
    vocab: DataFrame,
    label: str = "label",
    write: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rename ``label`` to ``gf_verbatim`` and add its standard meaning.

    A label the vocabulary lacks gets a NULL meaning and ``is_useless`` 0; a
    listed label keeps whatever flag was entered, NULL included. A label that
    is listed twice counts once, so rows never multiply.

    ``write`` writes the distinct labels before the join, as ``Stages.keep``
    does. Spark then broadcasts them by their exact size or else can split the
    rows of a label that fills much of the table.
    """
    known = meanings(vocab)
    known = write(known) if write else known
    m = F.col("__meaning")
    unlisted = F.lit(0).cast("smallint")
    return (
        df.withColumnRenamed(label, "gf_verbatim")
        .join(known, F.col("gf_verbatim") == F.col("__key"), "left")
        .withColumns(
            {
                "gf_std": blank_to_null(m["gf"]),
                "is_woody": m["is_woody"],
                "substrate": blank_to_null(m["substrate"]),
                "other": blank_to_null(m["other"]),
                "is_useless": F.when(m.isNull(), unlisted).otherwise(m["is_useless"]),
            }
        )
        .drop("__key", "__meaning")
    )


def drop_useless(df: DataFrame) -> DataFrame:
    """Drop labels marked uninterpretable; an unset mark keeps the row."""
    return df.filter(~F.col("is_useless").eqNullSafe(1))


def standardize(
    df: DataFrame,
    vocab: DataFrame,
    label: str = "label",
    write: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Interpretable attributions with their standard label."""
    return drop_useless(apply_vocab(df, vocab, label, write))

"""Drop lines that many documents share.

Lines are exploded, normalised and hashed; the distinct documents of each hash
are counted; lines over the threshold go and the rest is put together again by
position. Only hashes are shuffled for the count: the text of a line never
leaves its document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources import Stages
from .common import ROW_KEY, WHITE, hash128, lower_ascii, row_key


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _common_keys(lines: DataFrame, min_docs: int) -> DataFrame:
    return lines.groupBy("key").count().filter(F.col("count") >= min_docs).select("key")


def dedup_lines(
    docs: DataFrame,
    stages: Stages,
    min_docs: int = 10,
    min_chars: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The documents without their common lines, with ``n_lines, n_dropped``.

    A line's key is the line without white space at its ends, A-Z in lower
    case. Keys of at least ``min_chars`` characters that occur in at least
    ``min_docs`` rows lose all their lines. A row counts once for a key however
    often it repeats it; a repeated row counts each time it occurs.

    A NULL text is one empty line and becomes an empty text; an empty table
    stays empty. All columns stay; ``n_lines`` and ``n_dropped`` replace
    columns of the same name.
    """
    keys = F.filter(
        F.array_distinct(F.transform(_lines(text_column), line_key)),
        lambda key: F.length(key) >= max(min_chars, 0),
    )
    # the outer form, as the other adds a filter that computes the keys again
    exploded = F.explode_outer(F.transform(keys, hash128)).alias("key")
    lines = docs.select(*row_key(id_column, text_column), exploded).filter("key IS NOT NULL")
    common = stages.write("common_lines", _common_keys(lines, min_docs))
    found = lines.join(common, "key").groupBy(*ROW_KEY).agg(F.collect_set("key").alias("__drop"))
    found = found.withColumnsRenamed({c: f"{c}_found" for c in ROW_KEY})

    keyed = docs.select("*", *row_key(id_column, text_column))
    on = [keyed[c].eqNullSafe(found[f"{c}_found"]) for c in ROW_KEY]
    joined = keyed.join(found, on, "left")
    split = joined.withColumn("__lines", _lines(text_column))
    kept = split.withColumn(
        "__kept",
        F.when(F.col("__drop").isNull(), F.col("__lines")).otherwise(
            F.filter(
                "__lines", lambda line: ~F.array_contains(F.col("__drop"), hash128(line_key(line)))
            )
        ),
    )
    counted = kept.withColumns(
        {
            text_column: F.array_join("__kept", "\n"),
            "n_lines": F.size("__lines").cast("bigint"),
            "n_dropped": (F.size("__lines") - F.size("__kept")).cast("bigint"),
        }
    )
    names = dict.fromkeys([*docs.columns, "n_lines", "n_dropped"])
    return counted.select(*names)

"""Column expressions and small helpers shared by the text operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"

#: The columns of ``documents`` and ``labels`` that the operators read.
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"
BENCHMARK = "item_id bigint, text string"
PAGES = "page_id bigint, url string, html string"
SCHEMAS = {"documents": DOCUMENTS, "labels": LABELS, "benchmark": BENCHMARK, "pages": PAGES}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def hash128(value: Column) -> Column:
    """Two independent 64-bit hashes; the salt has to come first in the second."""
    return F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit(7), value).alias("b"))


#: Names for a row's identity that no table is likely to use itself.
ROW_KEY = ("__row_id", "__row_a", "__row_b")


def row_key(id_column: str, text_column: str) -> list[Column]:
    """Identifies a row by id and text, so that repeated ids are told apart.

    Rows equal in both are interchangeable: every decision on them is equal.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    return [
        F.col(id_column).alias(ROW_KEY[0]),
        F.xxhash64(text).alias(ROW_KEY[1]),
        F.xxhash64(F.lit(7), text).alias(ROW_KEY[2]),
    ]


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on :func:`row_key`; NULL ids are equal to each other."""
    a, b, c = ROW_KEY
    return left[a].eqNullSafe(right[a]) & (left[b] == right[b]) & (left[c] == right[c])


def bucket_of(doc_id: Column, buckets: int) -> Column:
    """The fold of a document: crc32 of its id as text; NULL ids are fold 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(buckets)), F.lit(0))

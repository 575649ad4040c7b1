"""Scans of the input tables and the files people exchange with the build."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..constants import GROWTH_FORM_TRAITS
from ..schemas import OBSERVATIONS, TRAITS, VOCABULARY
from .stages import Stages


def scan_traits(df: DataFrame, traits: Iterable[str] = GROWTH_FORM_TRAITS) -> DataFrame:
    """Records of the wanted traits; filter and columns reach the file scan."""
    return df.select(*TRAITS.names).filter(F.col("trait_name").isin(*traits))


def scan_observations(df: DataFrame) -> DataFrame:
    """Observations that carry a label; filter and columns reach the file scan."""
    return df.select(*OBSERVATIONS.names).filter(F.col("growth_form").isNotNull())


def read_traits(
    spark: SparkSession, path: str, traits: Iterable[str] = GROWTH_FORM_TRAITS
) -> DataFrame:
    return scan_traits(spark.read.schema(TRAITS).parquet(path), traits)


def write_traits(df: DataFrame, path: str) -> None:
    """Write trait records with a folder for each trait.

    ``read_traits`` then opens the folders of the wanted traits only, however
    many others there are.
    """
    df.select(*TRAITS.names).write.partitionBy("trait_name").parquet(path)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    return scan_observations(spark.read.schema(OBSERVATIONS).parquet(path))


#: Quotes in a field are doubled, as spreadsheets and databases do; blanks and
#: line breaks in a field are kept, and an empty text differs from a NULL.
_CSV = {"header": True, "quote": '"', "escape": '"', "emptyValue": '""'}
_WRITE = _CSV | {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_READ = {
    "header": True, "quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": True,
    "enforceSchema": False, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def write_vocab(vocab: DataFrame, path: str) -> None:
    """Write a vocabulary as CSV with a header, sorted, to be edited.

    A list short enough to work through lands in one file; a longer one in
    several that follow each other, so no task ever holds all of it.
    """
    vocab.orderBy("gf_verbatim").write.options(**_WRITE).csv(path)


def read_curated(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a table kept by hand as CSV with a header, e.g. name rules.

    An empty field is NULL; a row that does not fit the schema fails, and so
    does a header whose names differ from the schema's or stand in another
    order. Quotes in a field are doubled; a quoted field may hold line breaks.
    """
    return spark.read.schema(schema).options(**_READ).csv(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """Read an edited vocabulary."""
    return read_curated(spark, path, VOCABULARY)


def write_list(df: DataFrame, path: str) -> None:
    """Write a labelled list as CSV with a header, one file per partition."""
    df.write.options(**_WRITE).csv(path)


@dataclass(frozen=True)
class Imported:
    """The usable lines of a file, and the others with the reason."""

    rows: DataFrame
    refused: DataFrame


def import_curated(
    spark: SparkSession, path: str, schema: StructType, key: Iterable[str], stages: Stages
) -> Imported:
    """Read a table kept by hand and tell all that is wrong with it at once.

    ``refused`` has ``reason, file, line`` of each line that is not used:

    - ``malformed``: it does not fit the columns or their types;
    - ``no key``: no column of ``key`` is filled in;
    - ``conflict``: others have the same key but say something else, and a person
      has to choose, so none of them is used. Lines that are equal in all
      columns count once.

    ``line`` is the line as CSV. A header that does not match the schema still
    fails, since then no line can be trusted.
    """
    key, columns = list(key), schema.names
    options = {**_READ, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__line"}
    marked = StructType([*schema.fields, StructField("__line", StringType())])
    raw = spark.read.schema(marked).options(**options).csv(path)
    file = F.col("_metadata.file_name").alias("__file")
    # written, as lines are looked at more than once and a parse must not differ
    lines = stages.write(stages.fresh("imported"), raw.select(*columns, "__line", file))
    filled = F.lit(False)
    for column in key:
        text = F.col(column).cast("string")
        filled = filled | (F.coalesce(F.trim(text), F.lit("")) != "")
    distinct = F.struct(*columns)
    rest = lines.filter(F.col("__line").isNull() & filled)
    kinds = rest.groupBy(*key).agg(
        (F.min(distinct) != F.max(distinct)).alias("__conflict"), F.min(distinct).alias("__row")
    )
    kinds = stages.write(stages.fresh("keys"), kinds)
    rows = kinds.filter(~F.col("__conflict")).select("__row.*")
    conflicts = kinds.filter("__conflict").select(*(F.col(c).alias(f"__{c}") for c in key))
    same = [rest[c].eqNullSafe(conflicts[f"__{c}"]) for c in key]
    line = F.coalesce("__line", F.to_csv(distinct, {k: str(v).lower() for k, v in _WRITE.items()}))
    parts = {
        "malformed": lines.filter(F.col("__line").isNotNull()),
        "no key": lines.filter(F.col("__line").isNull() & ~filled),
        "conflict": rest.join(conflicts, same, "left_semi"),
    }
    refused = [
        part.select(F.lit(reason).alias("reason"), F.col("__file").alias("file"), line.alias("line"))
        for reason, part in parts.items()
    ]
    return Imported(rows, reduce(DataFrame.unionByName, refused))


def import_vocab(spark: SparkSession, path: str, stages: Stages) -> Imported:
    """:func:`import_curated` of an edited vocabulary."""
    return import_curated(spark, path, VOCABULARY, ["gf_verbatim"], stages)

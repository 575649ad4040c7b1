"""A corpus from raw documents to shards, one operator after the other.

Each stage is written as Parquet and read again before the next one begins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from traitvote.llm import decontaminate as leaks
from traitvote.llm import mixing, near_dedup, sharding
from traitvote.llm.common import DOCUMENTS, table
from traitvote.llm.language_id import fitted_for, identify
from traitvote.llm.queries import SHARD_BYTES, dimensions
from traitvote.sources import Stages

#: A document stays if one language has at least this share of it.
LEAST_SHARE = 0.5

COLUMNS = [field.split()[0] for field in DOCUMENTS.split(", ")]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, mostly in one language."""
    model = fitted_for(spark, sf_dir)
    found = identify(docs.select(*COLUMNS), model)
    return found.filter((F.col("lang_pred") != "und") & (F.col("lang_score") >= LEAST_SHARE)).select(
        *COLUMNS
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.keep_one(docs.select(*COLUMNS), Stages(spark))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without near copies of benchmark items."""
    found = leaks.find_items(docs, table(spark, sf_dir, "benchmark"), Stages(spark))
    return leaks.decontaminate(docs, found).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which sources, languages and topics have their target weights."""
    mixed = mixing.mix(docs, dimensions(), Stages(spark))
    return mixed.filter("kept").select(*COLUMNS)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the shard each belongs to."""
    return sharding.shard(docs.select(*COLUMNS), Stages(spark), SHARD_BYTES)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("shards", shards),
]

#: The stages learn language models and draw fingerprints, which SQL does not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    stages, docs = Stages(spark), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stages.write(name, stage(spark, docs, sf_dir))
    name, last = STAGES[-1]
    return stages.write(name, last(spark, docs, sf_dir))

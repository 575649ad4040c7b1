"""The queries of the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources import Stages
from . import decontaminate as leaks
from . import (
    html_extract,
    language_id,
    lexical_search,
    license_scan,
    line_dedup,
    merkle,
    mixing,
    near_dedup,
    quality_gam,
    quality_rules,
    sharding,
    simhash,
)
from .common import ROW_KEY, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SHARD_BYTES = 1 << 20
MIX_DIMENSIONS = {
    "source": F.col,
    "lang": F.col,
    "topic": lambda _: mixing.topic_of("text"),
}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_near_dedup(spark, sf_dir):
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), Stages(spark))
    return found.select(
        F.col(ROW_KEY[0]).alias("doc_id"), "n_shingles", "component_id", "kept"
    )


@query
def op2_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    done = line_dedup.dedup_lines(docs, Stages(spark))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op3_license_scan(spark, sf_dir):
    found = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text", "blocks")


@query
def op4_language_id(spark, sf_dir):
    model = language_id.fitted_for(spark, sf_dir)
    found = language_id.identify(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    held_out = language_id.is_held_out(F.col("doc_id")).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", F.col("lang_score").alias("score"))


@query
def op5_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages)).drop("html")


@query
def op6_quality_rules(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = quality_rules.judge(docs.select("doc_id", "text"), quality_rules.fit(docs, labels))
    return judged.drop("text")


@query
def op7_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    done = sharding.shard(docs, Stages(spark), SHARD_BYTES)
    return done.select("doc_id", "shard", "shard_depth", "n_bytes")


@query
def op8_quality_classifier(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = quality_gam.is_held_out(F.col("doc_id"))
    model = quality_gam.fit(docs, labels.filter(~held_out))
    scored = quality_gam.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def dimensions() -> dict:
    return {name: make(name) for name, make in MIX_DIMENSIONS.items()}


@query
def op9_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    done = mixing.mix(docs, dimensions(), Stages(spark))
    return done.select("doc_id", "n_tokens", F.round("probability", 4).alias("probability"), "kept")


@query
def op10_decontamination(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = leaks.find_items(docs, items, Stages(spark))
    return found.select(
        F.col(ROW_KEY[0]).alias("doc_id"), "item_id", "start", "n_common", "n_union", "similarity"
    )


@query
def op11_merkle_manifest(spark, sf_dir):
    rows = merkle.verified(merkle.manifest(table(spark, sf_dir, "documents"), Stages(spark)))
    proof = merkle.proof_digest(F.concat("segment", "top_segment")).alias("proof_sha256")
    text = {c: F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")}
    folded = F.lower(F.hex("folded")).alias("folded_root")
    verified = (F.col("folded") == F.col("root")).alias("verified")
    return rows.select("doc_id", *text.values(), proof, folded, verified)


@query
def op12_simhash_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), Stages(spark))
    return found.select(
        F.col(ROW_KEY[0]).alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query
def op13_lexical_search(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical_search.search(docs, items, Stages(spark))

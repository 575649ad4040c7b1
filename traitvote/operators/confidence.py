"""Confidence of a consensus from sample size and species coverage."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from ..constants import SPECIES
from ..functions import (
    confidence_flag,
    confidence_score,
    coverage_penalty,
    coverage_ratio,
    low_n_penalty,
)

SCORE_COLUMNS = [
    "penalty_gf_low_n",
    "spp",
    "spp_gf",
    "spp_gf_prop",
    "penalty_spp_gf_low_n",
    "gf_conf",
    "gf_conf_flag",
]


@dataclass(frozen=True)
class ConfidenceParams:
    """``pthresh``: records below which a penalty applies. ``pdenom``: the
    largest such penalty is 1/pdenom. ``pmax``: the largest penalty for
    species without a label. ``clamp``: count at most the listed species."""

    pthresh: int = 100
    pdenom: float | Decimal = 5
    pmax: float | Decimal = 0.2
    clamp: bool = False


def target_species(taxon: DataFrame) -> DataFrame:
    """The species of a taxon table, as a list to label."""
    return taxon.filter(F.col("taxon_rank") == SPECIES).select(
        "taxon_id", "family", "genus", "species"
    )


def listed_species(taxon: DataFrame, rank: str) -> DataFrame:
    """Distinct species per taxon of ``rank`` in the taxon table."""
    return (
        taxon.filter(F.col("taxon_rank") == SPECIES)
        .groupBy(rank)
        .agg(F.count_distinct(SPECIES).alias("spp"))
    )


def assessed_species(species_cons: DataFrame, rank: str) -> DataFrame:
    """Species per taxon of ``rank`` that have a consensus.

    A species consensus has one row for each species, so these are counted.
    """
    return (
        species_cons.filter(F.col("gf_cons").isNotNull())
        .groupBy(rank)
        .agg(F.count(SPECIES).alias("spp_gf"))
    )


def with_coverage(
    cons: DataFrame, rank: str, species_cons: DataFrame, taxon: DataFrame
) -> DataFrame:
    """Add ``spp`` and ``spp_gf``, 0 where there is none."""
    return (
        cons.drop("spp", "spp_gf")
        .join(listed_species(taxon, rank), rank, "left")
        .join(assessed_species(species_cons, rank), rank, "left")
        .fillna(0, subset=["spp", "spp_gf"])
    )


def species_confidence(
    cons: DataFrame, params: ConfidenceParams = ConfidenceParams()
) -> DataFrame:
    """Score a species consensus; running it again replaces the scores."""
    penalty = low_n_penalty(F.col("total_obs"), params.pthresh, params.pdenom)
    return (
        cons.drop(*SCORE_COLUMNS)
        .withColumn("penalty_gf_low_n", penalty)
        .withColumn("gf_conf", confidence_score(F.col("gf_cons_prop"), F.col("penalty_gf_low_n")))
        .withColumn("gf_conf_flag", confidence_flag(F.col("gf_conf")))
    )


def group_confidence(
    cons: DataFrame,
    rank: str,
    species_cons: DataFrame,
    taxon: DataFrame,
    params: ConfidenceParams = ConfidenceParams(),
) -> DataFrame:
    """Score a genus or family consensus, also by its species coverage.

    Where the taxon table lists no species the coverage is unknown and the
    score is 0.
    """
    spp, spp_gf = F.col("spp"), F.col("spp_gf")
    return (
        with_coverage(cons.drop(*SCORE_COLUMNS), rank, species_cons, taxon)
        .withColumn(
            "penalty_gf_low_n", low_n_penalty(F.col("total_obs"), params.pthresh, params.pdenom)
        )
        .withColumn("spp_gf_prop", coverage_ratio(spp_gf, spp))
        .withColumn(
            "penalty_spp_gf_low_n", coverage_penalty(spp_gf, spp, params.pmax, params.clamp)
        )
        .withColumn(
            "gf_conf",
            confidence_score(
                F.col("gf_cons_prop"), F.col("penalty_gf_low_n"), F.col("penalty_spp_gf_low_n")
            ),
        )
        .withColumn("gf_conf_flag", confidence_flag(F.col("gf_conf")))
    )

"""Consensus labels for taxa from many noisy attributions, on Spark."""

from .operators import ConfidenceParams, impute, impute_synonyms
from .plans import Consensus, Prepared, Source, build, label_list, prepare, vote
from .sources import ResumableStages, Stages

__all__ = [
    "ConfidenceParams",
    "Consensus",
    "Prepared",
    "ResumableStages",
    "Source",
    "Stages",
    "build",
    "impute",
    "impute_synonyms",
    "label_list",
    "prepare",
    "vote",
]

"""Column expressions; all of them stay inside Spark's generated code."""

from .labels import blank_to_null, clean_label, first_word, label_priority
from .scores import (
    confidence_flag,
    confidence_score,
    coverage_penalty,
    coverage_ratio,
    low_n_penalty,
    share,
)

__all__ = [
    "blank_to_null",
    "clean_label",
    "confidence_flag",
    "confidence_score",
    "coverage_penalty",
    "coverage_ratio",
    "first_word",
    "label_priority",
    "low_n_penalty",
    "share",
]

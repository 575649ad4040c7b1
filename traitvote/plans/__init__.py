"""Whole runs: building the consensus tables and labelling a list with them."""

from .build import (
    Consensus,
    Prepared,
    Source,
    build,
    counted_rows,
    flagged_homonyms,
    label_list,
    labelled_rows,
    prepare,
    review_names,
    vote,
    votes_of,
)

__all__ = [
    "Consensus",
    "Prepared",
    "Source",
    "build",
    "counted_rows",
    "flagged_homonyms",
    "label_list",
    "labelled_rows",
    "prepare",
    "review_names",
    "vote",
    "votes_of",
]

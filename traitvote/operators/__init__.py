"""DataFrame operators; each takes and returns DataFrames and runs no job."""

from .checks import assert_ok, check_all, check_parent, check_rank_assigned, row_metrics
from .clean import (
    as_attributions,
    clean_attributions,
    clean_labels,
    collapse,
    drop_unplaced,
    exclude_taxa,
    rank_of,
    with_rank,
)
from .confidence import (
    ConfidenceParams,
    assessed_species,
    group_confidence,
    listed_species,
    species_confidence,
    target_species,
    with_coverage,
)
from .counts import (
    at_rank,
    count_attributions,
    family_obs,
    family_votes,
    genus_obs,
    genus_votes,
    merge_counts,
    roll_up,
    stack_counts,
)
from .coverage import count_species, merge_bitmaps, number_species, species_bitmaps
from .homonyms import (
    flag_homonyms,
    homonym_names,
    homonym_pairs,
    homonym_review,
    homonym_summary,
)
from .impute import (
    impute,
    impute_keyed,
    impute_synonyms,
    label_synonyms,
    relabel_synonyms,
    resolve_synonyms,
    with_genus,
)
from .names import (
    accepted_names,
    correct_names,
    fix_names,
    name_changes,
    with_original_names,
)
from .overrides import apply_overrides, exclude_groups, with_notes
from .pages import epithet, inspect_page
from .synonyms import one_name_per_synonym, synonym_table
from .vocab import apply_vocab, drop_useless, standardize, verbatim_vocab
from .vote import all_labels, consensus, with_priority

__all__ = [
    "ConfidenceParams",
    "accepted_names",
    "all_labels",
    "apply_overrides",
    "apply_vocab",
    "as_attributions",
    "assert_ok",
    "assessed_species",
    "at_rank",
    "check_all",
    "check_parent",
    "check_rank_assigned",
    "clean_attributions",
    "clean_labels",
    "collapse",
    "consensus",
    "correct_names",
    "count_attributions",
    "count_species",
    "drop_unplaced",
    "drop_useless",
    "epithet",
    "exclude_groups",
    "exclude_taxa",
    "family_obs",
    "family_votes",
    "fix_names",
    "flag_homonyms",
    "genus_obs",
    "genus_votes",
    "group_confidence",
    "homonym_names",
    "homonym_pairs",
    "homonym_review",
    "homonym_summary",
    "impute",
    "impute_keyed",
    "impute_synonyms",
    "inspect_page",
    "label_synonyms",
    "listed_species",
    "merge_bitmaps",
    "merge_counts",
    "name_changes",
    "number_species",
    "one_name_per_synonym",
    "rank_of",
    "relabel_synonyms",
    "resolve_synonyms",
    "roll_up",
    "row_metrics",
    "species_bitmaps",
    "species_confidence",
    "stack_counts",
    "standardize",
    "synonym_table",
    "target_species",
    "verbatim_vocab",
    "with_coverage",
    "with_genus",
    "with_notes",
    "with_original_names",
    "with_priority",
    "with_rank",
]

"""Schemas of the tables that cross a file boundary or are written by hand."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_text, _flag, _big, _yes = T.StringType(), T.ShortType(), T.LongType(), T.BooleanType()

TRAITS = _schema(
    id=_big,
    scrubbed_family=_text,
    scrubbed_genus=_text,
    scrubbed_species_binomial=_text,
    trait_name=_text,
    trait_value=_text,
    country=_text,
    state_province=_text,
    authorship=_text,
    authorship_contact=_text,
    citation_bibtex=_text,
    project_pi=_text,
    is_individual_trait=_flag,
    is_species_trait=_flag,
)

OBSERVATIONS = _schema(
    taxonobservation_id=_big,
    observation_type=_text,
    datasource=_text,
    scrubbed_family=_text,
    scrubbed_genus=_text,
    scrubbed_species_binomial=_text,
    growth_form=_text,
)

TAXON = _schema(taxon_id=_big, family=_text, genus=_text, species=_text, taxon_rank=_text)

# One row per verbatim label, filled in by a person between export and import.
VOCABULARY = _schema(
    gf_verbatim=_text,
    gf=_text,
    is_woody=_flag,
    substrate=_text,
    other=_text,
    is_useless=_flag,
)

# (genus, family) pairs a person judged to be homonyms; family may be NULL.
HOMONYM_FLAGS = _schema(genus=_text, family=_text, is_homonym_genus=_flag, check_species=_flag)

# scope says which of family/genus/species a rule matches on; set_* say which
# names it writes (a written name may be NULL); copy_species keeps the species
# of the matched row; an untracked rule leaves name_updated alone.
NAME_RULES = _schema(
    scope=_text,
    family=_text,
    genus=_text,
    species=_text,
    acc_family=_text,
    acc_genus=_text,
    acc_species=_text,
    set_family=_yes,
    set_genus=_yes,
    set_species=_yes,
    copy_species=_yes,
    track=_yes,
)

# Rows to drop by name; NULL or blank in a rule matches NULL or blank in a row.
TAXON_EXCLUSIONS = _schema(family=_text, genus=_text, species=_text)

# NULL leaves the voted value as it is.
OVERRIDES = _schema(
    family=_text,
    gf_cons=_text,
    gf_all=_text,
    gf_cons_obs=_big,
    gf_cons_prop=T.DecimalType(5, 2),
    clear_inferred_from_ranks=_yes,
    notes=_text,
)

# Families whose members are labelled at the family rank only.
GROUP_EXCLUSIONS = _schema(family=_text)

SYNONYMS = _schema(
    family=_text,
    genus=_text,
    species=_text,
    family_orig=_text,
    genus_orig=_text,
    species_orig=_text,
)

USER_LIST = _schema(family=_text, species=_text)

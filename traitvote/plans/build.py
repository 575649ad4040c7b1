"""The build from attributions to scored consensus tables, and its use."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..constants import FAMILY, GENUS, LABEL_PRIORITY, RANKS, SPECIES
from ..operators import (
    ConfidenceParams,
    accepted_names,
    apply_overrides,
    apply_vocab,
    check_all,
    clean_labels,
    collapse,
    consensus,
    correct_names,
    drop_unplaced,
    drop_useless,
    exclude_groups,
    exclude_taxa,
    family_votes,
    fix_names,
    flag_homonyms,
    genus_votes,
    group_confidence,
    homonym_pairs,
    homonym_review,
    impute,
    label_synonyms,
    merge_counts,
    relabel_synonyms,
    roll_up,
    row_metrics,
    species_confidence,
    synonym_table,
    with_notes,
    with_original_names,
)
from ..operators.names import ACCEPTED
from ..sources import Stages, tasks_for


@dataclass(frozen=True)
class Source:
    """One set of attributions and what people decided about it.

    ``rows`` has ``family, genus, species, label`` and, if it is already
    counted, a column named by ``weight``. ``vocab`` is needed for the vote
    only. The curation tables are optional: ``flags`` and ``rules`` together
    correct homonyms (a flagged name without a rule is given up), ``fixes``
    overwrite names before homonyms are looked for, ``exclusions`` drop taxa
    after the correction.
    """

    rows: DataFrame
    vocab: DataFrame | None = None
    strip: tuple[str, ...] = ("*",)
    weight: str | None = None
    fixes: DataFrame | None = None
    flags: DataFrame | None = None
    rules: DataFrame | None = None
    exclusions: DataFrame | None = None
    genus_rule_scope: str = "all"

    def __post_init__(self) -> None:
        if (self.flags is None) != (self.rules is None):
            raise ValueError("flags and rules go together; an empty table will do")

    @property
    def has_review(self) -> bool:
        return self.flags is not None

    @property
    def is_corrected(self) -> bool:
        return self.fixes is not None or self.has_review


@dataclass(frozen=True)
class Prepared:
    """Sources ready for the vote: counted rows by name, and changed names.

    ``observed`` has what ``row_metrics`` found of each source's counted rows
    while they were written.
    """

    rows: dict[str, DataFrame]
    synonyms: DataFrame | None
    observed: dict[str, dict[str, object]] = field(default_factory=dict)


@dataclass(frozen=True)
class Consensus:
    """The tables a build leaves behind; ``checks`` are those of the counts."""

    species: DataFrame
    genus: DataFrame
    family: DataFrame
    synonyms: DataFrame | None
    labelled_synonyms: DataFrame | None
    counts: DataFrame
    checks: DataFrame


def counted_rows(source: Source, stages: Stages | None = None) -> DataFrame:
    """Distinct placed (names, label) of a source, with their number ``n``.

    Rows whose label is blank stay: their names still take part in the search
    for homonyms. Original names are kept only where fixes change the names.
    """
    rows = clean_labels(drop_unplaced(source.rows), strip=source.strip)
    rows = collapse(rows, *RANKS, "label", weight=source.weight)
    if source.fixes is None:
        return rows
    write = stages.keep("fixes") if stages else None
    return fix_names(with_original_names(rows), source.fixes, write)


def flagged_homonyms(
    source: Source, rows: DataFrame, stages: Stages | None = None
) -> DataFrame:
    """The genera with several families among the rows, flags beside them."""
    write = stages.keep("homonym_names") if stages else None
    return flag_homonyms(homonym_pairs(rows, GENUS, write=write), source.flags)


def review_names(source: Source, rows: DataFrame, flagged: DataFrame) -> DataFrame:
    """The names under flagged homonyms with those to use instead."""
    return accepted_names(homonym_review(flagged, rows), source.rules)


def labelled_rows(
    source: Source,
    rows: DataFrame,
    review: DataFrame | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """Counted rows with corrected names, without exclusions and blank labels."""
    if source.fixes is None:
        rows = with_original_names(rows)
    if review is not None:
        write = stages.keep("review_lines") if stages else None
        rows = correct_names(rows, review, source.genus_rule_scope, write)
    if source.exclusions is not None:
        rows = exclude_taxa(rows, source.exclusions)
    return rows.filter(F.col("label").isNotNull())


def votes_of(rows: DataFrame, vocab: DataFrame, stages: Stages | None = None) -> DataFrame:
    """Counted rows as votes for a standard label."""
    write = stages.keep("vocab") if stages else None
    return (
        drop_useless(apply_vocab(rows, vocab, write=write))
        .filter(F.col("gf_std").isNotNull())
        .select(*RANKS, F.col("gf_std").alias("gf"), F.col("n").alias("obs"))
    )


def prepare(sources: Mapping[str, Source], stages: Stages) -> Prepared:
    """Count, correct and clean the rows of all sources.

    One pass over the records of each source leaves counted rows, which are
    written, as all later steps read them. Every short table that a long one
    is joined to is written as well, so that Spark broadcasts it by its exact
    size or not at all.

    What a person has to look at exists now: the vocabulary of a source is
    ``verbatim_vocab(prepared.rows[name])``.
    """
    rows = stages.write_all(
        {f"{name}_rows": counted_rows(s, stages) for name, s in sources.items()}, row_metrics()
    )
    observed = {name: stages.observed[f"{name}_rows"] for name in sources}
    reviewed = {name: s for name, s in sources.items() if s.has_review}
    homonyms = stages.write_all(
        {f"{n}_homonyms": flagged_homonyms(s, rows[f"{n}_rows"], stages) for n, s in reviewed.items()}
    )
    reviews = stages.write_all(
        {
            f"{n}_review": review_names(s, rows[f"{n}_rows"], homonyms[f"{n}_homonyms"])
            for n, s in reviewed.items()
        }
    )
    labelled = {
        name: labelled_rows(source, rows[f"{name}_rows"], reviews.get(f"{name}_review"), stages)
        for name, source in sources.items()
    }
    # votes, synonyms and the vocabulary read corrected rows, so these are written
    changed = {f"{n}_labelled": labelled[n] for n, s in sources.items() if s.is_corrected}
    for name, written in stages.write_all(changed).items():
        labelled[name.removesuffix("_labelled")] = written
    corrected = [labelled[name] for name, source in sources.items() if source.is_corrected]
    return Prepared(labelled, synonym_table(*corrected) if corrected else None, observed)


def vote(
    prepared: Prepared,
    vocabs: Mapping[str, DataFrame],
    taxon: DataFrame,
    stages: Stages,
    overrides: DataFrame | None = None,
    exclusions: DataFrame | Mapping[str, DataFrame] | None = None,
    params: ConfidenceParams = ConfidenceParams(),
    priority: Mapping[str, int] = LABEL_PRIORITY,
    double_count: bool = True,
) -> Consensus:
    """Vote and score a consensus at all three ranks.

    Counts of all ranks come from one aggregation over all sources. Overrides
    and exclusions act before scoring, so an excluded family has no assessed
    species. Exclusions are one list of families for species and genera, or a
    list for each of the two by name. ``double_count=False`` counts species
    records once in a family.
    """
    votes = {name: votes_of(rows, vocabs[name], stages) for name, rows in prepared.rows.items()}
    n_rows = sum(found["rows"] for found in prepared.observed.values())
    tables = {"counts": merge_counts(votes, tasks_for(taxon.sparkSession, n_rows))}
    if prepared.synonyms is not None:
        tables["synonyms"] = prepared.synonyms
    tables = stages.write_all(tables)
    counts, synonyms = tables["counts"], tables.get("synonyms")

    rolled = stages.write("rolled", roll_up(counts, double_count))
    species = with_notes(consensus(counts, SPECIES, priority))
    genus = with_notes(consensus(genus_votes(rolled), GENUS, priority))
    family = with_notes(consensus(family_votes(rolled), FAMILY, priority))

    if overrides is not None:
        family = apply_overrides(family, overrides)
    if exclusions is not None:
        by_rank = exclusions
        if not isinstance(exclusions, Mapping):
            by_rank = {SPECIES: exclusions, GENUS: exclusions}
        if SPECIES in by_rank:
            species = exclude_groups(species, by_rank[SPECIES])
        if GENUS in by_rank:
            genus = exclude_groups(genus, by_rank[GENUS])

    species = stages.write("species", species_confidence(species, params))
    groups = stages.write_all(
        {
            "genus": group_confidence(genus, GENUS, species, taxon, params),
            "family": group_confidence(family, FAMILY, species, taxon, params),
        }
    )
    genus, family = groups["genus"], groups["family"]
    labelled_synonyms = None
    if synonyms is not None:
        labelled_synonyms = stages.write(
            "labelled_synonyms", label_synonyms(synonyms, species, genus, family)
        )
    checks = stages.write("checks", check_all(counts))
    return Consensus(species, genus, family, synonyms, labelled_synonyms, counts, checks)


def build(
    sources: Mapping[str, Source], taxon: DataFrame, stages: Stages, **options
) -> Consensus:
    """:func:`prepare` the sources and :func:`vote`, with its options."""
    vocabs = {name: source.vocab for name, source in sources.items()}
    missing = [name for name, vocab in vocabs.items() if vocab is None]
    if missing:
        raise ValueError(f"no vocabulary for {', '.join(missing)}")
    return vote(prepare(sources, stages), vocabs, taxon, stages, **options)


def label_list(
    species_list: DataFrame, built: Consensus, correct_synonyms: bool = False
) -> DataFrame:
    """Label a list of (family, species), on request also under accepted names.

    With ``correct_synonyms`` there are always columns for the accepted names;
    without corrected names in the build they are NULL.
    """
    labelled = impute(species_list, built.species, built.genus, built.family)
    if not correct_synonyms:
        return labelled
    if built.labelled_synonyms is None:
        labelled = labelled.drop("name_updated", *ACCEPTED)
        nothing = {c: F.lit(None).cast("string") for c in ACCEPTED}
        return labelled.withColumns(nothing | {"name_updated": F.lit(None).cast("int")})
    return relabel_synonyms(labelled, built.labelled_synonyms)

"""One query per operator, over the inputs of :mod:`adapter`."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import operators as op
from ..constants import FAMILY, GENUS, RANKS, SPECIES
from ..functions import confidence_flag, coverage_penalty, coverage_ratio, low_n_penalty
from ..plans import (
    Consensus,
    Source,
    build,
    counted_rows,
    label_list,
    labelled_rows,
    prepare,
    votes_of,
)
from ..sources import (
    ResumableStages,
    Stages,
    import_vocab,
    read_curated,
    read_traits,
    read_vocab,
    scan_observations,
    scan_traits,
    tasks_for,
    write_keyed,
    write_list,
    write_traits,
    write_vocab,
)
from . import adapter

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__.removeprefix("q_")] = function
    return function


# --- Inputs shared by several queries ---------------------------------------


def _clean_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean_attributions(adapter.traits(spark, sf_dir))


def _standard_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op.with_original_names(_clean_traits(spark, sf_dir))
    return op.standardize(rows, adapter.trait_vocab(spark)).drop("applies_to_rank")


def _sources(spark: SparkSession, sf_dir: str) -> dict[str, Source]:
    """Both sources as they are, names uncorrected."""
    return {
        "traits": Source(adapter.traits(spark, sf_dir), adapter.trait_vocab(spark)),
        "observations": Source(
            adapter.observations(spark, sf_dir), adapter.observation_vocab(spark), strip=()
        ),
    }


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged counts; the counted rows of the sources are written, as in a build.

    So a task counts or merges, and the number of rows tells how many merge.
    """
    sources = _sources(spark, sf_dir)
    counted = Stages(spark).write_all({name: counted_rows(s) for name, s in sources.items()})
    votes = {
        name: votes_of(labelled_rows(source, counted[name]), source.vocab)
        for name, source in sources.items()
    }
    return op.merge_counts(votes, tasks_for(spark, sum(rows.count() for rows in counted.values())))


def _written_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts as a table, for queries that read them more than once."""
    return Stages(spark).write("counts", _counts(spark, sf_dir))


def _built(spark: SparkSession, sf_dir: str) -> Consensus:
    return build(_sources(spark, sf_dir), adapter.taxon(spark, sf_dir), Stages(spark))


def _homonyms(spark: SparkSession, sf_dir: str, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The flagged genera among the rows, and the distinct names of the rows.

    Both are written: the names serve the search for homonyms and the list of
    their species, and the short list of genera has to be known as short.
    """
    stages = Stages(spark)
    names = stages.write("names", rows.select(*RANKS).distinct())
    pairs = op.homonym_pairs(names, GENUS)
    flagged = op.flag_homonyms(pairs, adapter.homonym_flags(spark, sf_dir))
    return stages.write("homonyms", flagged), names


def _review(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Accepted names of the flagged names among the rows."""
    review = op.homonym_review(*_homonyms(spark, sf_dir, rows))
    accepted = op.accepted_names(review, adapter.name_rules(spark, sf_dir))
    return Stages(spark).write("review", accepted)


def _corrected_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapter.traits(spark, sf_dir)
    review = _review(spark, sf_dir, rows)
    return op.correct_names(op.with_original_names(rows), review, write=Stages(spark).keep("lines"))


def _union(**parts: DataFrame) -> DataFrame:
    tagged = [df.withColumn("input", F.lit(name)) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, tagged)


# --- Scans, projections, filters ---------------------------------------------


@query
def q_scan_traits(spark, sf_dir):
    return scan_traits(Stages(spark).write("traits", adapter.trait_records(spark, sf_dir)))


@query
def q_scan_traits_by_name(spark, sf_dir):
    """The same from a source with a folder for each trait."""
    path = f"{Stages(spark).path}/traits"
    write_traits(adapter.trait_records(spark, sf_dir), path)
    return read_traits(spark, path)


@query
def q_scan_observations(spark, sf_dir):
    return scan_observations(adapter.observation_records(spark, sf_dir))


@query
def q_target_species(spark, sf_dir):
    return op.target_species(adapter.taxon(spark, sf_dir))


@query
def q_drop_unplaced(spark, sf_dir):
    return op.drop_unplaced(adapter.sparse_traits(spark, sf_dir))


@query
def q_rank_of(spark, sf_dir):
    return op.with_rank(adapter.sparse_traits(spark, sf_dir))


@query
def q_clean_labels(spark, sf_dir):
    return op.clean_labels(adapter.traits(spark, sf_dir))


@query
def q_clean_attributions(spark, sf_dir):
    return op.clean_attributions(adapter.sparse_traits(spark, sf_dir))


@query
def q_collapse(spark, sf_dir):
    rows = op.clean_labels(adapter.observations(spark, sf_dir), strip=())
    return op.collapse(rows, *RANKS, "label")


@query
def q_derive_genus(spark, sf_dir):
    return op.with_genus(adapter.species_list(spark, sf_dir))


# --- Checks and homonyms -----------------------------------------------------


@query
def q_check_rank_assigned(spark, sf_dir):
    rows = adapter.sparse_traits(spark, sf_dir)
    return _union(
        raw=op.check_rank_assigned(rows),
        placed=op.check_rank_assigned(op.drop_unplaced(rows)),
    )


@query
def q_check_species_parent(spark, sf_dir):
    return _union(
        traits=op.check_parent(adapter.traits(spark, sf_dir), SPECIES),
        observations=op.check_parent(adapter.observations(spark, sf_dir), SPECIES),
    )


@query
def q_check_genus_parent(spark, sf_dir):
    return _union(
        traits=op.check_parent(adapter.traits(spark, sf_dir), GENUS),
        corrected_traits=op.check_parent(_corrected_traits(spark, sf_dir), GENUS),
        observations=op.check_parent(adapter.observations(spark, sf_dir), GENUS),
    )


@query
def q_checks(spark, sf_dir):
    rows = op.clean_labels(adapter.sparse_traits(spark, sf_dir))
    counted = op.collapse(rows, *RANKS, "label")
    return op.check_all(Stages(spark).write("rows", counted))


@query
def q_row_metrics(spark, sf_dir):
    """What the jobs that make the counted rows of both sources find on their way."""
    prepared = prepare(_sources(spark, sf_dir), Stages(spark))
    found = [
        (name, metrics["rows"], metrics["records"], metrics["unplaced"])
        for name, metrics in prepared.observed.items()
    ]
    columns = "source string, rows bigint, records bigint, unplaced bigint"
    return spark.createDataFrame(found, columns)


@query
def q_homonym_genera_by_names(spark, sf_dir):
    """The names are found first, then only their pairs."""
    rows = adapter.sparse_traits(spark, sf_dir)
    return op.homonym_pairs(rows, GENUS, write=Stages(spark).keep("names"))


@query
def q_homonym_species(spark, sf_dir):
    return op.homonym_pairs(adapter.traits(spark, sf_dir), SPECIES)


@query
def q_homonym_genera(spark, sf_dir):
    return op.homonym_pairs(adapter.sparse_traits(spark, sf_dir), GENUS)


@query
def q_homonym_summary(spark, sf_dir):
    pairs = op.homonym_pairs(adapter.traits(spark, sf_dir), SPECIES)
    return op.homonym_summary(pairs, SPECIES, "species")


@query
def q_homonym_flags(spark, sf_dir):
    pairs = op.homonym_pairs(adapter.sparse_traits(spark, sf_dir), GENUS)
    return op.flag_homonyms(pairs, adapter.homonym_flags(spark, sf_dir))


@query
def q_homonym_review(spark, sf_dir):
    rows = adapter.sparse_traits(spark, sf_dir)
    return op.homonym_review(*_homonyms(spark, sf_dir, rows))


# --- Name correction ---------------------------------------------------------


@query
def q_review_accepted_names(spark, sf_dir):
    return _review(spark, sf_dir, adapter.traits(spark, sf_dir))


@query
def q_fix_names(spark, sf_dir):
    rows = op.with_original_names(adapter.traits(spark, sf_dir))
    return op.fix_names(rows, adapter.name_fixes(spark, sf_dir), Stages(spark).keep("fixes"))


@query
def q_correct_names(spark, sf_dir):
    return _corrected_traits(spark, sf_dir)


@query
def q_exclude_taxa(spark, sf_dir):
    return op.exclude_taxa(
        adapter.traits(spark, sf_dir), adapter.taxon_exclusions(spark, sf_dir)
    )


@query
def q_name_changes(spark, sf_dir):
    return op.name_changes(_corrected_traits(spark, sf_dir), "id")


@query
def q_synonyms(spark, sf_dir):
    changed = op.clean_labels(_corrected_traits(spark, sf_dir)).filter("label IS NOT NULL")
    same = op.with_original_names(adapter.observations(spark, sf_dir))
    return op.synonym_table(changed, same)


# --- Vocabulary ----------------------------------------------------------------


@query
def q_verbatim_vocab(spark, sf_dir):
    return op.verbatim_vocab(_clean_traits(spark, sf_dir))


@query
def q_vocab_roundtrip(spark, sf_dir):
    """The vocabulary through its file, with labels that CSV makes awkward."""
    labels = _clean_traits(spark, sf_dir).select("label").distinct()
    label = F.col("label")
    awkward = labels.select(
        F.explode(
            F.array(
                label,
                F.concat(F.lit("\t"), label),
                F.concat(F.lit(" "), label),
                F.concat(F.lit('a "'), label, F.lit('" b')),
                F.concat(F.lit('say "'), label, F.lit('", y')),
                F.concat(label, F.lit("\nnext")),
            )
        ).alias("label")
    )
    path = f"{Stages(spark).path}/vocab.csv"
    write_vocab(op.verbatim_vocab(awkward), path)
    return read_vocab(spark, path)


def edited_vocab(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """A vocabulary as CSV lines some of which are wrong, and where it is.

    Each label has a good line twice. Of every third label there is also a line
    with another meaning, of the others one with a word for a number, and one
    without a label.
    """
    labels = _clean_traits(spark, sf_dir).select("label").distinct()
    quoted = 'concat(\'"\', label, \'"\')'
    good = f"concat({quoted}, ',tree,1,terrestrial,,0')"
    other = (
        f"CASE WHEN length(label) % 3 = 0 THEN concat({quoted}, ',herb,0,,,0')"
        f" ELSE concat({quoted}, ',tree,many,,,0') END"
    )
    nameless = "concat(',', 'shrub,1,', label, ',,0')"
    lines = labels.selectExpr(f"explode(array({good}, {good}, {other}, {nameless})) AS value")
    path = f"{Stages(spark).path}/edited"
    header = ",".join(adapter.VOCABULARY.names)
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    headed = F.when(first, F.concat(F.lit(header + "\n"), "value")).otherwise(F.col("value"))
    lines.repartition(2).select(headed.alias("value")).write.text(path)  # each part has a header
    return labels, path


@query
def q_import_vocab(spark, sf_dir):
    """The usable lines of a vocabulary with wrong ones."""
    _, path = edited_vocab(spark, sf_dir)
    return import_vocab(spark, path, Stages(spark)).rows


@query
def q_import_vocab_refused(spark, sf_dir):
    """How many lines of it are refused, by reason and start of the line."""
    _, path = edited_vocab(spark, sf_dir)
    refused = import_vocab(spark, path, Stages(spark)).refused
    start = F.regexp_replace(F.substring_index("line", ",", 1), '"', "").alias("start")
    return refused.groupBy("reason", start).agg(F.count(F.lit(1)).alias("n"))


@query
def q_list_roundtrip(spark, sf_dir):
    """A labelled list through its file."""
    labelled = q_impute_direct(spark, sf_dir)
    path = f"{Stages(spark).path}/list.csv"
    write_list(labelled, path)
    return read_curated(spark, path, labelled.schema)


@query
def q_apply_vocab(spark, sf_dir):
    partial = adapter.trait_vocab(spark).filter("gf_verbatim != '5-low'")
    return op.apply_vocab(_clean_traits(spark, sf_dir), partial, write=Stages(spark).keep("vocab"))


@query
def q_drop_useless(spark, sf_dir):
    rows = op.apply_vocab(_clean_traits(spark, sf_dir), adapter.trait_vocab(spark))
    return op.drop_useless(rows).select("id", "gf_verbatim", "gf_std", "is_useless")


@query
def q_standardize_attributions(spark, sf_dir):
    return _standard_traits(spark, sf_dir)


# --- Counts and roll-ups -------------------------------------------------------


@query
def q_count_species(spark, sf_dir):
    return op.count_attributions(_standard_traits(spark, sf_dir), SPECIES)


@query
def q_count_genus(spark, sf_dir):
    return op.count_attributions(_standard_traits(spark, sf_dir), GENUS)


@query
def q_count_family(spark, sf_dir):
    return op.count_attributions(_standard_traits(spark, sf_dir), FAMILY)


@query
def q_species_obs(spark, sf_dir):
    return op.with_priority(_counts(spark, sf_dir).filter(op.at_rank(SPECIES)))


@query
def q_genus_obs(spark, sf_dir):
    return op.with_priority(op.genus_obs(_counts(spark, sf_dir)))


@query
def q_family_obs(spark, sf_dir):
    return op.with_priority(op.family_obs(_counts(spark, sf_dir)))


@query
def q_family_obs_counted_once(spark, sf_dir):
    return op.family_obs(_counts(spark, sf_dir), double_count=False)


@query
def q_genus_votes(spark, sf_dir):
    rolled = Stages(spark).write("rolled", op.roll_up(_counts(spark, sf_dir)))
    return op.with_priority(op.genus_votes(rolled))


@query
def q_family_votes(spark, sf_dir):
    rolled = Stages(spark).write("rolled", op.roll_up(_counts(spark, sf_dir)))
    return op.with_priority(op.family_votes(rolled))


@query
def q_family_votes_counted_once(spark, sf_dir):
    rolled = op.roll_up(_counts(spark, sf_dir), double_count=False)
    return op.family_votes(Stages(spark).write("rolled", rolled))


# --- Vote ------------------------------------------------------------------------


@query
def q_label_priority(spark, sf_dir):
    return op.with_priority(_counts(spark, sf_dir).select("gf").distinct())


@query
def q_all_labels(spark, sf_dir):
    return op.all_labels(_counts(spark, sf_dir).filter(op.at_rank(SPECIES)), SPECIES)


@query
def q_species_consensus(spark, sf_dir):
    return op.consensus(_counts(spark, sf_dir), SPECIES)


@query
def q_genus_consensus(spark, sf_dir):
    return op.consensus(op.genus_obs(_counts(spark, sf_dir)), GENUS)


@query
def q_family_consensus(spark, sf_dir):
    return op.consensus(op.family_obs(_counts(spark, sf_dir)), FAMILY)


@query
def q_apply_overrides(spark, sf_dir):
    return op.apply_overrides(q_family_consensus(spark, sf_dir), adapter.overrides(spark))


@query
def q_exclude_families(spark, sf_dir):
    return op.exclude_groups(q_species_consensus(spark, sf_dir), adapter.group_exclusions(spark))


# --- Confidence --------------------------------------------------------------------


@query
def q_penalty_low_n(spark, sf_dir):
    return q_species_consensus(spark, sf_dir).select(
        "species", "total_obs", low_n_penalty(F.col("total_obs")).alias("penalty_gf_low_n")
    )


@query
def q_species_coverage_genus(spark, sf_dir):
    counts = _written_counts(spark, sf_dir)
    genera = op.consensus(op.genus_obs(counts), GENUS).select("genus")
    species = op.consensus(counts, SPECIES)
    return op.with_coverage(genera, GENUS, species, adapter.taxon(spark, sf_dir))


@query
def q_species_coverage_family(spark, sf_dir):
    counts = _written_counts(spark, sf_dir)
    families = op.consensus(op.family_obs(counts), FAMILY).select("family")
    species = op.consensus(counts, SPECIES)
    return op.with_coverage(families, FAMILY, species, adapter.taxon(spark, sf_dir))


@query
def q_merged_coverage(spark, sf_dir):
    """Listed and assessed species of each genus and family, from bitmaps.

    The taxon table comes in two batches that overlap; the second one's new
    species are numbered after the first one's, whose bitmaps stay as they are.
    """
    stages, taxon = Stages(spark), adapter.taxon(spark, sf_dir)
    listed = taxon.filter(F.col("taxon_rank") == SPECIES).select(*RANKS, "taxon_id")
    earlier, later = listed.filter("taxon_id % 3 != 0"), listed.filter("taxon_id % 2 = 0 OR taxon_id % 3 = 0")
    numbers = op.number_species(earlier, stages)
    first = stages.write("first", op.species_bitmaps(earlier, numbers))
    numbers = op.number_species(later, stages, numbers)
    second = stages.write("second", op.species_bitmaps(later, numbers))
    assessed = op.consensus(_counts(spark, sf_dir), SPECIES).filter("gf_cons IS NOT NULL")
    spp = op.count_species(op.merge_bitmaps(first, second))
    spp_gf = op.count_species(op.species_bitmaps(assessed, numbers), "spp_gf")
    return spp.join(spp_gf, ["rank", "taxon"], "left").fillna(0, ["spp_gf"])


@query
def q_penalty_coverage(spark, sf_dir):
    spp, spp_gf = F.col("spp"), F.col("spp_gf")
    return q_species_coverage_genus(spark, sf_dir).select(
        "genus",
        "spp",
        "spp_gf",
        coverage_ratio(spp_gf, spp).alias("spp_gf_prop"),
        coverage_penalty(spp_gf, spp).alias("penalty_spp_gf_low_n"),
    )


@query
def q_species_confidence(spark, sf_dir):
    return op.species_confidence(q_species_consensus(spark, sf_dir))


def _group_confidence(spark: SparkSession, sf_dir: str, rank: str) -> DataFrame:
    counts = _written_counts(spark, sf_dir)
    votes = op.genus_obs(counts) if rank == GENUS else op.family_obs(counts)
    return op.group_confidence(
        op.consensus(votes, rank),
        rank,
        op.consensus(counts, SPECIES),
        adapter.taxon(spark, sf_dir),
    )


@query
def q_genus_confidence(spark, sf_dir):
    return _group_confidence(spark, sf_dir, GENUS)


@query
def q_family_confidence(spark, sf_dir):
    return _group_confidence(spark, sf_dir, FAMILY)


@query
def q_confidence_flag(spark, sf_dir):
    scored = q_species_confidence(spark, sf_dir)
    return scored.select("species", "gf_conf", confidence_flag(F.col("gf_conf")).alias("flag"))


@query
def q_inspect_page(spark, sf_dir):
    scored = q_species_confidence(spark, sf_dir)
    return op.inspect_page(scored, op.epithet(), "species", limit=25, offset=30)


@query
def q_inspect_deep_page(spark, sf_dir):
    """A page far down the observations, read from the partition that holds it."""
    rows = adapter.observations(spark, sf_dir)
    return op.inspect_page(
        rows, op.epithet(), "species", "id", "label", limit=25, offset=4900, stages=Stages(spark)
    )


# --- Imputation ----------------------------------------------------------------------


@query
def q_impute_direct(spark, sf_dir):
    species = Stages(spark).write("species", q_species_confidence(spark, sf_dir))
    return op.impute(adapter.species_list(spark, sf_dir), species)


@query
def q_impute_cascade(spark, sf_dir):
    return label_list(adapter.species_list(spark, sf_dir), _built(spark, sf_dir))


def keyed_tables(spark: SparkSession, sf_dir: str, built: Consensus, buckets: int = 8):
    """A list with hot species and the species consensus, dealt to equal buckets."""
    stages = Stages(spark)
    listed = adapter.species_list(spark, sf_dir)
    nameless = listed.filter("taxon_id % 10 = 0").withColumn(SPECIES, F.lit(None).cast("string"))
    again = listed.filter("taxon_id = 1").withColumn("taxon_id", F.explode(F.sequence(F.lit(-50), F.lit(-1))))
    given = listed.unionByName(nameless).unionByName(again.withColumn("taxon_id", F.col("taxon_id").cast("bigint")))
    keyed = write_keyed(given, SPECIES, buckets, stages, "list", hot_rows=20)
    return keyed, stages.write_bucketed("species_by_name", built.species, SPECIES, buckets)


@query
def q_impute_keyed(spark, sf_dir):
    """The cascade for a list that is joined where it lies."""
    built = _built(spark, sf_dir)
    keyed, species = keyed_tables(spark, sf_dir, built)
    return op.impute_keyed(keyed, species, built.genus, built.family)


def _written_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Stages(spark).write("synonyms", q_synonyms(spark, sf_dir))


@query
def q_resolve_synonyms(spark, sf_dir):
    rows = op.with_genus(adapter.species_list_with_old_names(spark, sf_dir))
    return op.resolve_synonyms(
        rows, _written_synonyms(spark, sf_dir), Stages(spark).keep("one_name")
    )


@query
def q_impute_synonyms(spark, sf_dir):
    built = _built(spark, sf_dir)
    imputed = label_list(adapter.species_list_with_old_names(spark, sf_dir), built)
    synonyms = _written_synonyms(spark, sf_dir)
    return op.impute_synonyms(imputed, synonyms, built.species, built.genus, built.family)


def corrected_sources(spark: SparkSession, sf_dir: str) -> dict[str, Source]:
    """Both sources with every kind of curation."""
    flags = adapter.homonym_flags(spark, sf_dir)
    return {
        "traits": Source(
            adapter.traits(spark, sf_dir),
            adapter.trait_vocab(spark),
            flags=flags,
            rules=adapter.name_rules(spark, sf_dir),
            exclusions=adapter.taxon_exclusions(spark, sf_dir),
        ),
        "observations": Source(
            adapter.observations(spark, sf_dir),
            adapter.observation_vocab(spark),
            strip=(),
            fixes=adapter.name_fixes(spark, sf_dir),
            flags=flags,
            rules=adapter.observation_rules(spark, sf_dir),
        ),
    }


def corrected_build(
    spark: SparkSession, sf_dir: str, stages: Stages | None = None
) -> Consensus:
    """The whole build with every kind of curation."""
    excluded = adapter.group_exclusions(spark)
    return build(
        corrected_sources(spark, sf_dir),
        adapter.taxon(spark, sf_dir),
        stages or Stages(spark),
        overrides=adapter.overrides(spark),
        exclusions={SPECIES: excluded, GENUS: excluded.filter("family != 'ASIA'")},
    )


@query
def q_build_and_label(spark, sf_dir):
    rows = adapter.species_list_with_old_names(spark, sf_dir)
    return label_list(rows, corrected_build(spark, sf_dir), correct_synonyms=True)


@query
def q_build_resumed(spark, sf_dir):
    """The same by a run that ended after its preparation and was started again."""
    run = uuid.uuid4().hex
    root = Stages(spark).path
    prepare(corrected_sources(spark, sf_dir), ResumableStages(spark, run, root))
    built = corrected_build(spark, sf_dir, ResumableStages(spark, run, root))
    rows = adapter.species_list_with_old_names(spark, sf_dir)
    return label_list(rows, built, correct_synonyms=True)


@query
def q_build_genus(spark, sf_dir):
    return corrected_build(spark, sf_dir).genus


@query
def q_build_family(spark, sf_dir):
    return corrected_build(spark, sf_dir).family


@query
def q_build_species(spark, sf_dir):
    return corrected_build(spark, sf_dir).species


@query
def q_build_counts(spark, sf_dir):
    return corrected_build(spark, sf_dir).counts


@query
def q_build_synonyms(spark, sf_dir):
    return corrected_build(spark, sf_dir).synonyms


@query
def q_check_counts(spark, sf_dir):
    return corrected_build(spark, sf_dir).checks


@query
def q_standardize_corrected(spark, sf_dir):
    """The record-level table after correction and exclusion."""
    rows = op.exclude_taxa(
        _corrected_traits(spark, sf_dir), adapter.taxon_exclusions(spark, sf_dir)
    )
    cleaned = op.clean_labels(rows).filter("label IS NOT NULL")
    write = Stages(spark).keep("vocab")
    return op.standardize(cleaned, adapter.trait_vocab(spark), write=write)

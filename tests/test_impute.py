from decimal import Decimal

import fixtures
import pytest
from conftest import expect, rows
from pyspark.sql import functions as F

from traitvote import impute, impute_synonyms
from traitvote import operators as op
from traitvote.schemas import GROUP_EXCLUSIONS, OVERRIDES, SYNONYMS

LABELS = "gf gf_conf gf_method"


@pytest.fixture(scope="module")
def consensus(table):
    return [df.persist() for df in fixtures.consensus(table)]


def test_cascade(table, consensus):
    given = table(
        "family string, species string",
        ("F", "G a"),
        ("F", "G z"),
        ("Q", "G z"),
        ("F", "H x"),
        ("F", None),
        ("Q", "K k"),
        ("Q", "K k"),
    )
    done = impute(given, *consensus)
    expect(
        done,
        f"family species genus {LABELS}",
        ("F", "G a", "G", "tree", Decimal("0.21"), "direct from species"),
        ("F", "G z", "G", "vine", Decimal("0.02"), "imputed from genus"),
        ("Q", "G z", "G", "vine", Decimal("0.02"), "imputed from genus"),
        ("F", "H x", "H", "herb", Decimal("0.12"), "imputed from family"),
        ("F", None, None, "herb", Decimal("0.12"), "imputed from family"),
        ("Q", "K k", "K", None, None, None),
        ("Q", "K k", "K", None, None, None),
    )
    assert rows(impute(done, *consensus), *done.columns) == rows(done)


def test_direct_only(table, consensus):
    given = table("family string, species string", ("F", "G a"), ("F", "G z"))
    expect(
        impute(given, consensus[0]),
        f"species {LABELS}",
        ("G a", "tree", Decimal("0.21"), "direct from species"),
        ("G z", None, None, None),
    )


def test_existing_genus_and_labels_are_replaced(table, consensus):
    given = table(
        "family string, genus string, species string, gf string, note string",
        ("F", "wrong", "G a", "old", "kept"),
    )
    expect(
        impute(given, *consensus), "genus gf note", ("G", "tree", "kept")
    )


def test_match_without_label_falls_through(table, consensus):
    species, genus, family = consensus
    unlabelled = species.withColumn("gf_cons", F.lit(None).cast("string"))
    given = table("family string, species string", ("F", "G a"), ("Q", "G a"))
    expect(
        impute(given, unlabelled, genus.limit(0), family),
        f"family {LABELS}",
        ("F", "herb", Decimal("0.12"), "imputed from family"),
        ("Q", None, Decimal("0.21"), "direct from species"),
    )


def test_synonyms(table, consensus):
    synonyms = table(
        SYNONYMS,
        ("F", "G", None, "Fx", "Ox", "Ox a"),
        ("F", "G", "G a", "Fx", "Ox", "Ox a"),
        (None, None, None, "Fx", "Oz", "Oz a"),
        ("F", "G", "G z", "Fx", "Ow", "Ow a"),
        ("F", "G", "G a", "Fx", "Ov", None),
    )
    given = table(
        "family string, species string",
        ("Fx", "Ox a"),
        ("Fx", "Oz a"),
        ("Fx", "Ow a"),
        ("Fx", "Ow a"),
        ("F", "G b"),
        ("Fx", None),
    )
    names = "family species name_updated acc_family acc_genus acc_species"
    accepted = {
        ("Fx", "Ox a"): (1, "F", "G", "G a"),
        ("Fx", "Oz a"): (1, None, None, None),
        ("Fx", "Ow a"): (1, "F", "G", "G z"),
        ("F", "G b"): (None, None, None, None),
        ("Fx", None): (None, None, None, None),
    }
    resolved = op.resolve_synonyms(op.with_genus(given), synonyms)
    listed = [tuple(r) for r in given.collect()]
    expect(resolved, names, *(key + accepted[key] for key in listed))

    done = impute_synonyms(impute(given, *consensus), synonyms, *consensus)
    labels = {
        ("Fx", "Ox a"): ("tree", Decimal("0.21"), "direct from species"),
        ("Fx", "Oz a"): (None, None, None),
        ("Fx", "Ow a"): ("vine", Decimal("0.02"), "imputed from genus"),
        ("F", "G b"): ("herb", Decimal("0.81"), "direct from species"),
        ("Fx", None): (None, None, None),
    }
    expect(
        done, f"{names} {LABELS}", *(key + accepted[key] + labels[key] for key in listed)
    )
    again = impute_synonyms(done, synonyms, *consensus)
    assert rows(again, *done.columns) == rows(done)


def test_overrides_and_exclusions_before_scoring(table):
    merged = op.merge_counts(fixtures.counts(table))
    overrides = table(OVERRIDES, ("F", "vine", "vine", None, None, None, "by hand"))
    excluded = table(GROUP_EXCLUSIONS, ("F",))
    species = op.exclude_groups(op.consensus(merged, "species"), excluded)
    genus = op.exclude_groups(op.consensus(op.genus_obs(merged), "genus"), excluded)
    family = op.apply_overrides(op.consensus(op.family_obs(merged), "family"), overrides)
    assert species.count() == genus.count() == 0
    expect(
        op.group_confidence(family, "family", species, fixtures.taxon(table)),
        "gf_cons gf_all gf_cons_obs total_obs gf_cons_prop notes inferred_from_ranks "
        "spp_gf penalty_spp_gf_low_n gf_conf",
        ("vine", "vine", 8, 21, Decimal("0.38"), "by hand", "family,genus,species",
         0, Decimal("-0.20"), Decimal("0.02")),
    )


def test_override_clears_ranks_and_sets_numbers(table):
    merged = op.merge_counts(fixtures.counts(table))
    overrides = table(OVERRIDES, ("F", None, None, 9, Decimal("0.40"), True, None))
    family = op.apply_overrides(op.consensus(op.family_obs(merged), "family"), overrides)
    expect(
        family,
        "gf_cons gf_cons_obs total_obs gf_cons_prop notes inferred_from_ranks",
        ("herb", 9, 21, Decimal("0.40"), None, None),
    )


@pytest.mark.parametrize(
    "rank, prop, total, spp, spp_gf, low_n, coverage, conf, flag",
    [
        ("species", "1.0", 1, None, None, "-0.20", None, "0.80", "high"),
        ("species", "0.9", 100, None, None, "0.00", None, "0.90", "very high"),
        ("species", "0.7", 3, None, None, "-0.19", None, "0.51", "med"),
        ("species", "0.5", 50, None, None, "-0.10", None, "0.40", "low"),
        ("species", "0.3", 4, None, None, "-0.19", None, "0.11", "very low"),
        ("genus", "1.0", 100, 0, 0, "0.00", None, "0.00", "very low"),
        ("genus", "0.8", 100, 2, 3, "0.00", "0.10", "0.90", "very high"),
        ("genus", "1.0", 100, 40, 17, "0.00", "-0.12", "0.88", "high"),
    ],
)
def test_confidence(table, rank, prop, total, spp, spp_gf, low_n, coverage, conf, flag):
    cons = table(
        fixtures.NAMES + ", gf_cons string, total_obs bigint, gf_cons_prop decimal(4,1)",
        ("F", "G", "G s", "tree", total, Decimal(prop)),
    )
    if rank == "species":
        scored = op.species_confidence(cons)
    else:
        assessed = table(
            fixtures.NAMES + ", gf_cons string",
            *(("F", "G", f"G {i}", "tree") for i in range(spp_gf)),
            ("F", "G", "G none", None),
        )
        taxon = table(
            fixtures.NAMES + ", taxon_rank string",
            *(("F", "G", f"G {i}", "species") for i in range(spp)),
            ("F", "G", None, "genus"),
        )
        scored = op.group_confidence(cons, "genus", assessed, taxon)
        expected = Decimal(coverage) if coverage else None
        expect(scored, "spp spp_gf penalty_spp_gf_low_n", (spp, spp_gf, expected))
    expect(
        scored,
        "penalty_gf_low_n gf_conf gf_conf_flag",
        (Decimal(low_n), Decimal(conf), flag),
    )

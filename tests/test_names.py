import pytest
from conftest import expect
from pyspark.sql import functions as F

from traitvote import operators as op
from traitvote.schemas import HOMONYM_FLAGS, NAME_RULES

NAMES = "family string, genus string, species string"


def rule(scope, family=None, genus=None, species=None, track=True, copy_species=False, **accepted):
    """A rule that writes the names given, e.g. ``acc_family="F"``."""
    names = ("family", "genus", "species")
    return (
        scope,
        family,
        genus,
        species,
        *(accepted.get(f"acc_{n}") for n in names),
        *(f"acc_{n}" in accepted for n in names),
        copy_species,
        track,
    )


@pytest.fixture(scope="module")
def attributions(table):
    return table(
        "id string, " + NAMES,
        ("r1", "Fx", "Gx", "Gx a"),
        ("r2", "Fx", "Gx", None),
        ("r3", "Fa", "Gx", "Gx b"),
        ("r4", "Fx", "Gz", "Gz a"),
        ("r5", "Fx", "Gz", "Gz b"),
        ("r6", "Fa", "Gz", "Gz c"),
    )


@pytest.fixture(scope="module")
def flags(table):
    return table(HOMONYM_FLAGS, ("Gx", "Fx", 1, 1), ("Gz", "Fx", 1, 0), ("Gq", "Fx", 1, 0))


@pytest.fixture(scope="module")
def rules(table):
    return table(
        NAME_RULES,
        rule("species", species="Gx a", acc_family="Fy", acc_genus="Gy", acc_species="Gy a"),
        rule(
            "genus_family_null_species",
            family="Fx",
            genus="Gx",
            acc_family="Fy",
            acc_genus="Gy",
            acc_species=None,
        ),
        rule("species", species="Gz a", acc_family="Fy", acc_genus="Gw", acc_species="Gw a"),
    )


def corrected(attributions, flags, rules, **options):
    flagged = op.flag_homonyms(op.homonym_pairs(attributions, "genus"), flags)
    review = op.accepted_names(op.homonym_review(flagged, attributions), rules)
    return op.correct_names(op.with_original_names(attributions), review, **options)


def test_homonyms_are_listed_and_flagged(attributions, flags):
    pairs = op.homonym_pairs(attributions, "genus")
    expect(
        op.flag_homonyms(pairs, flags),
        "genus family is_homonym_genus check_species",
        ("Gx", "Fa", 0, 0),
        ("Gx", "Fx", 1, 1),
        ("Gz", "Fa", 0, 0),
        ("Gz", "Fx", 1, 0),
    )
    expect(op.homonym_summary(pairs, "genus", "genera"), "genera_with_homonyms homonyms", (2, 2))


def test_review_lists_species_of_flagged_pairs(attributions, flags):
    flagged = op.flag_homonyms(op.homonym_pairs(attributions, "genus"), flags)
    expect(
        op.homonym_review(flagged, attributions),
        "genus family species",
        ("Gx", "Fx", "Gx a"),
        ("Gx", "Fx", None),
        ("Gz", "Fx", "Gz a"),
        ("Gz", "Fx", "Gz b"),
    )


def test_null_parents_do_not_count_but_are_listed(table):
    df = table(
        NAMES,
        ("A", "G", "G a"),
        ("B", "G", "G a"),
        (None, "G", "G a"),
        ("A", "H", "H a"),
        (None, "H", "H a"),
        ("A", None, None),
        ("B", None, None),
    )
    pairs = op.homonym_pairs(df, "genus")
    expect(pairs, "genus family", ("G", "A"), ("G", "B"), ("G", None))
    flags = table(HOMONYM_FLAGS, ("G", None, 1, 0))
    flagged = op.flag_homonyms(pairs, flags)
    expect(
        flagged,
        "genus family is_homonym_genus",
        ("G", "A", 0),
        ("G", "B", 0),
        ("G", None, 1),
    )
    # No row equals a NULL family: the pair keeps one line and corrects nothing.
    review = op.homonym_review(flagged, df)
    expect(review, "genus family species", ("G", None, None))
    fixed = op.correct_names(
        op.with_original_names(df), op.accepted_names(review, table(NAME_RULES))
    )
    assert fixed.filter("name_updated = 1").count() == 0


def test_genus_line_wins_and_unruled_lines_lose_their_names(attributions, flags, rules):
    expect(
        corrected(attributions, flags, rules),
        "id family genus species family_orig genus_orig species_orig name_updated",
        ("r1", "Fy", "Gy", None, "Fx", "Gx", "Gx a", 1),
        ("r2", "Fy", "Gy", None, "Fx", "Gx", None, 1),
        ("r3", "Fa", "Gx", "Gx b", "Fa", "Gx", "Gx b", 0),
        ("r4", "Fy", "Gw", "Gw a", "Fx", "Gz", "Gz a", 1),
        ("r5", None, None, None, "Fx", "Gz", "Gz b", 1),
        ("r6", "Fa", "Gz", "Gz c", "Fa", "Gz", "Gz c", 0),
    )


def test_genus_line_can_be_kept_to_rows_without_species(attributions, flags, rules):
    fixed = corrected(attributions, flags, rules, genus_rule_scope="null_species_only")
    expect(
        fixed.filter("genus_orig = 'Gx' AND family_orig = 'Fx'"),
        "id family genus species",
        ("r1", "Fy", "Gy", "Gy a"),
        ("r2", "Fy", "Gy", None),
    )
    with pytest.raises(ValueError, match="genus_rule_scope"):
        corrected(attributions, flags, rules, genus_rule_scope="some")


def test_checks_before_and_after(attributions, flags, rules):
    assert op.check_parent(attributions, "genus").first()[0] is True
    fixed = corrected(attributions, flags, rules)
    check = op.check_parent(fixed, "genus")
    assert check.first()[0] is False
    op.assert_ok(check, False)
    with pytest.raises(ValueError, match="has_homonym_genus"):
        op.assert_ok(check, True)


def test_changes_and_synonyms(attributions, flags, rules):
    fixed = corrected(attributions, flags, rules)
    changes = op.name_changes(fixed, "id")
    assert [tuple(r)[:3] for r in changes.collect()] == [
        ("Fx", "Gx", None),
        ("Fx", "Gx", "Gx a"),
        ("Fx", "Gz", "Gz a"),
        ("Fx", "Gz", "Gz b"),
    ]
    expect(
        op.synonym_table(fixed.unionByName(fixed), fixed),
        "family genus species family_orig genus_orig species_orig",
        ("Fy", "Gy", None, "Fx", "Gx", "Gx a"),
        ("Fy", "Gy", None, "Fx", "Gx", None),
        ("Fy", "Gw", "Gw a", "Fx", "Gz", "Gz a"),
        (None, None, None, "Fx", "Gz", "Gz b"),
    )


def test_later_scopes_win_per_name(table):
    review = table(NAMES, ("S", "M", "M balsamiferum"), ("S", "M", "M other"), ("S", "M", None))
    rules = table(
        NAME_RULES,
        rule(
            "genus_family",
            family="S",
            genus="M",
            acc_family="Fab",
            acc_genus="M",
            acc_species=None,
            copy_species=True,
        ),
        rule("species", species="M balsamiferum", acc_species="M balsamum"),
    )
    expect(
        op.accepted_names(review, rules),
        "species acc_family acc_genus acc_species",
        ("M balsamiferum", "Fab", "M", "M balsamum"),
        ("M other", "Fab", "M", "M other"),
        (None, "Fab", "M", None),
    )


def test_point_fix_leaves_no_trace_unless_tracked(table):
    df = op.with_original_names(
        table(NAMES, ("E", "A", "A l"), ("P", "A", "A l"), ("E", "B", "B b"), ("E", "C", "C c"))
    )
    rules = table(
        NAME_RULES,
        rule("species_family", family="E", species="A l", acc_family="P", track=False),
        rule("species", species="B b", acc_genus=None, track=True),
    )
    expect(
        op.fix_names(df, rules),
        "family genus species family_orig name_updated",
        ("P", "A", "A l", "E", 0),
        ("P", "A", "A l", "P", 0),
        ("E", None, "B b", "E", 1),
        ("E", "C", "C c", "E", 0),
    )


def test_duplicate_rules_do_not_multiply_rows(attributions, flags, rules):
    fixed = corrected(attributions, flags.unionAll(flags), rules.unionAll(rules))
    assert fixed.count() == attributions.count()
    assert fixed.filter(F.col("name_updated") == 1).count() == 4

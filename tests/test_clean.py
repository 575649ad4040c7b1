from conftest import expect

from traitvote import operators as op

NAMES = "family string, genus string, species string"


def test_rank_is_decided_by_nulls(table):
    df = table(
        NAMES,
        ("F", "G", "S"),
        ("F", None, "S"),
        ("F", "G", None),
        (None, "G", None),
        ("F", None, None),
        (None, None, None),
        ("", None, None),
    )
    expect(
        op.with_rank(op.drop_unplaced(df)),
        "family genus species applies_to_rank",
        ("F", "G", "S", "species"),
        ("F", None, "S", "species"),
        ("F", "G", None, "genus"),
        (None, "G", None, "genus"),
        ("F", None, None, "family"),
        ("", None, None, "family"),
    )
    assert op.check_rank_assigned(df).first()[0] is False
    assert op.check_rank_assigned(op.drop_unplaced(df)).first()[0] is True


def test_clean_attributions(table):
    df = table(
        NAMES + ", label string",
        ("F", "G", "S", "Tree*"),
        ("F", "G", "S", " * "),
        (None, None, None, "Tree"),
    )
    expect(
        op.clean_attributions(df),
        "family genus species label applies_to_rank",
        ("F", "G", "S", "tree", "species"),
    )


def test_collapse_counts_or_sums(table):
    df = table("family string, n bigint", ("F", 2), ("F", 3), (None, 1), (None, 1))
    expect(op.collapse(df.select("family"), "family"), "family n", ("F", 2), (None, 2))
    expect(op.collapse(df, "family", weight="n"), "family n", ("F", 5), (None, 2))


def test_exclusion_treats_blank_as_null(table):
    df = table(
        NAMES,
        (None, "T", None),
        (" ", "T", ""),
        ("F", "T", None),
        (None, "T", "T a"),
        (None, "U", None),
    )
    exclusions = table(NAMES, ("  ", "T", None))
    expect(
        op.exclude_taxa(df, exclusions),
        "family genus species",
        ("F", "T", None),
        (None, "T", "T a"),
        (None, "U", None),
    )

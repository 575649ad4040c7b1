"""The worked example of a genus with four species, two sources, three ranks."""

NAMES = "family string, genus string, species string"


def counts(table):
    """Counted attributions of both sources, all ranks."""
    schema = NAMES + ", gf string, obs bigint"
    return {
        "traits": table(
            schema,
            ("F", "G", "G a", "tree", 2),
            ("F", "G", "G a", "shrub", 1),
            ("F", "G", "G a", "herb", 1),
            ("F", "G", None, "vine", 4),
        ),
        "observations": table(
            schema,
            ("F", "G", "G a", "shrub", 1),
            ("F", "G", "G b", "herb", 3),
            ("F", None, None, "tree", 1),
            (None, "G", "G a", "liana", 9),
        ),
    }


def taxon(table):
    return table(
        "taxon_id bigint, " + NAMES + ", taxon_rank string",
        *((i, "F", "G", f"G {s}", "species") for i, s in enumerate("abcd")),
        (9, "F", "G", None, "genus"),
    )


def consensus(table):
    """Scored consensus tables, without overrides."""
    from traitvote import operators as op

    merged = op.merge_counts(counts(table))
    species = op.species_confidence(op.consensus(merged, "species"))
    genus = op.consensus(op.genus_obs(merged), "genus")
    family = op.consensus(op.family_obs(merged), "family")
    return (
        species,
        op.group_confidence(genus, "genus", species, taxon(table)),
        op.group_confidence(family, "family", species, taxon(table)),
    )

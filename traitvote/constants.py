"""Names and fixed values shared by the operators."""

from __future__ import annotations

from decimal import Decimal

# The three levels, coarsest first. A row belongs to the finest level it names.
FAMILY, GENUS, SPECIES = RANKS = ("family", "genus", "species")

# --- Fixed values: these decide the results and must stay as they are. ---

# Larger growth forms win a tied vote; a label that is not listed ranks 0.
LABEL_PRIORITY = {
    "tree": 7,
    "shrub": 6,
    "liana": 5,
    "bambusoid": 4,
    "subshrub": 3,
    "vine": 2,
    "herb": 1,
}

# Lower bounds of the confidence categories, best first; below the last one
# a score is CONFIDENCE_FLOOR_FLAG.
CONFIDENCE_FLAGS = {
    "very high": Decimal("0.90"),
    "high": Decimal("0.75"),
    "med": Decimal("0.50"),
    "low": Decimal("0.25"),
}
CONFIDENCE_FLOOR_FLAG = "very low"

# How an imputed label was found.
METHODS = {
    SPECIES: "direct from species",
    GENUS: "imputed from genus",
    FAMILY: "imputed from family",
}

# The trait that holds growth forms in a mixed trait table.
GROWTH_FORM_TRAITS = ("whole plant growth form",)

# Digits kept of the winning share: one for species and genus, two for family.
SHARE_DIGITS = {SPECIES: 1, GENUS: 1, FAMILY: 2}

from decimal import Decimal
from fractions import Fraction

import pytest
from conftest import expect, rows
from pyspark.sql import functions as F

from traitvote import functions as fn


@pytest.mark.parametrize(
    "strip, cases",
    [
        (
            ("*",),
            {" *Tree* ": "tree", "Tree *": "tree", "***": None, "   ": None, "\tTree": "\ttree"},
        ),
        ((), {"*Tree ": "*tree", "": None, None: None}),
        (("*", "?"), {"T?r*ee": "tree"}),
    ],
)
def test_clean_label(table, strip, cases):
    df = table("label string", *((label,) for label in cases))
    expect(
        df.select("label", fn.clean_label(F.col("label"), strip).alias("clean")),
        "label clean",
        *cases.items(),
    )


def test_blank_to_null_keeps_spaces_of_other_values(table):
    df = table("x string", (" ",), ("",), (" a ",), (None,))
    expect(
        df.select("x", fn.blank_to_null(F.col("x")).alias("y")),
        "x y",
        (" ", None),
        ("", None),
        (" a ", " a "),
        (None, None),
    )


def test_first_word(table):
    df = table("x string", ("Poa annua",), ("Poa",), ("",), (None,))
    expect(
        df.select("x", fn.first_word(F.col("x")).alias("y")),
        "x y",
        ("Poa annua", "Poa"),
        ("Poa", "Poa"),
        ("", ""),
        (None, None),
    )


def test_label_priority(table):
    sizes = {
        "tree": 7, "shrub": 6, "liana": 5, "bambusoid": 4, "subshrub": 3, "vine": 2, "herb": 1,
        "hemiepiphyte": 0, "vina": 0, None: None,
    }
    df = table("gf string", *((gf,) for gf in sizes))
    sized = df.select("gf", fn.label_priority(F.col("gf")).alias("size"))
    expect(sized, "gf size", *sizes.items())
    assert sized.schema["size"].dataType.simpleString() == "smallint"


def half_up(x: Fraction, digits: int) -> Decimal:
    """Round half away from zero, exactly."""
    scaled = abs(x) * 10**digits
    whole = int(scaled + Fraction(1, 2))
    return Decimal(whole if x >= 0 else -whole).scaleb(-digits)


def test_share_rounds_half_away_from_zero(spark):
    pairs = spark.range(1, 301).selectExpr("id AS b").join(
        spark.range(301).selectExpr("id AS a"), F.expr("a <= b")
    )
    got = pairs.select(
        "a", "b", fn.share(F.col("a"), F.col("b"), 1), fn.share(F.col("a"), F.col("b"), 2)
    )
    for a, b, one, two in got.collect():
        assert one == half_up(Fraction(a, b), 1)
        assert two == half_up(Fraction(a, b), 2)


def test_low_n_penalty(spark):
    df = spark.range(0, 250).select(
        "id",
        fn.low_n_penalty(F.col("id")),
        fn.low_n_penalty(F.col("id"), pthresh=50, pdenom=10),
        fn.low_n_penalty(F.col("id"), pthresh=200, pdenom="2.5"),
    )
    for n, default, below, above in df.collect():
        assert default == half_up(-(1 - Fraction(min(n, 100), 100)) / 5, 2)
        assert below == half_up(-(1 - Fraction(min(n, 50), 100)) / 10, 2)
        assert above == half_up(-(1 - Fraction(min(n, 200), 100)) / Fraction(5, 2), 2)


def test_low_n_penalty_of_unknown_total_is_that_of_the_threshold(table):
    df = table("n bigint", (None,)).select(fn.low_n_penalty(F.col("n"), pthresh=50))
    assert df.first()[0] == Decimal("-0.10")


def test_coverage_penalty_is_exact(spark):
    pairs = spark.range(1, 401).selectExpr("id AS spp").join(
        spark.range(401).selectExpr("id AS spp_gf"), F.expr("spp_gf <= spp")
    )
    got = pairs.select(
        "spp", "spp_gf", fn.coverage_penalty(F.col("spp_gf"), F.col("spp")).alias("p")
    )
    for spp, spp_gf, p in got.collect():
        assert p == half_up(-(1 - Fraction(spp_gf, spp)) / 5, 2)


def test_coverage_beyond_the_listed_species(table):
    df = table("spp bigint, spp_gf bigint", (2, 3), (0, 3))
    spp, spp_gf = F.col("spp"), F.col("spp_gf")
    expect(
        df.select(
            "spp",
            fn.coverage_ratio(spp_gf, spp).alias("ratio"),
            fn.coverage_penalty(spp_gf, spp).alias("p"),
            fn.coverage_penalty(spp_gf, spp, clamp=True).alias("clamped"),
        ),
        "spp ratio p clamped",
        (2, 1.5, Decimal("0.10"), Decimal("0.00")),
        (0, None, None, None),
    )


def test_confidence_score_and_flag(table):
    df = table(
        "prop decimal(4,1), a decimal(3,2), b decimal(3,2)",
        (Decimal("0.1"), Decimal("-0.19"), Decimal("0.00")),
        (Decimal("1.0"), Decimal("0.00"), None),
        (Decimal("0.8"), Decimal("0.00"), Decimal("0.10")),
    )
    score = fn.confidence_score(F.col("prop"), F.col("a"), F.col("b"))
    expect(
        df.select("prop", score.alias("s"), fn.confidence_flag(score).alias("f")),
        "prop s f",
        (Decimal("0.1"), Decimal("0.00"), "very low"),
        (Decimal("1.0"), Decimal("0.00"), "very low"),
        (Decimal("0.8"), Decimal("0.90"), "very high"),
    )


def test_confidence_flag_bounds(table):
    bounds = {
        "0.90": "very high", "0.89": "high", "0.75": "high", "0.74": "med", "0.50": "med",
        "0.49": "low", "0.25": "low", "0.24": "very low", "0.00": "very low",
    }
    df = table("s decimal(3,2)", *((Decimal(s),) for s in bounds), (None,))
    got = dict(rows(df.select("s", fn.confidence_flag(F.col("s")).alias("f"))))
    assert got == {Decimal(s): flag for s, flag in bounds.items()} | {None: None}

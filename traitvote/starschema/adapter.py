"""Inputs of the build derived from the star-schema tables.

A customer is a species, its nation the genus, its region the family. An
order attributes its priority to the customer's species and a line item its
return flag and status. Remainders of the order key blank out names and labels,
dirty labels and misplace names in the family ``Unknown``. A supplier is a
species without records: some have a genus of their own, some also a family.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..constants import GROWTH_FORM_TRAITS, RANKS
from ..operators import as_attributions, target_species
from ..schemas import GROUP_EXCLUSIONS, NAME_RULES, OVERRIDES, VOCABULARY
from ..sources import scan_observations, scan_traits, tasks_for
from ..sources.sizes import TASK_ROWS

UNKNOWN = "Unknown"

# --- Fixed values: the meaning of the labels that occur in the tables. ---
TRAIT_MEANINGS = [
    ("1-urgent", "tree", 1, "terrestrial", None, 0),
    ("2-high", "shrub", 1, "terrestrial", " ", 0),
    ("3-medium", "herb", 0, "terrestrial", "annual", 0),
    ("4-not specified", None, None, None, None, 1),
    ("5-low", "liana", 1, "climber", None, 0),
]
OBSERVATION_MEANINGS = [
    ("ro", "tree", 1, "terrestrial", None, 0),
    ("rf", "shrub", 1, "terrestrial", None, 0),
    ("ao", "liana", 1, "climber", None, 0),
    ("af", "hemiepiphyte", None, "epiphyte", None, 0),
    ("no", "herb", 0, "terrestrial", None, 0),
    ("nf", "vine", 0, "climber", None, 0),
]


def lookup(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small hand-written table whose size Spark knows when it plans."""
    columns = zip(*rows, strict=True)
    arrays = [
        pa.array(values, type=field.type)
        for values, field in zip(columns, to_arrow_schema(schema), strict=True)
    ]
    return spark.createDataFrame(pa.table(arrays, names=schema.names), schema)


# The columns that are read, so that no file has to be opened to plan a query.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_returnflag string, l_linestatus string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their region: a fixed handful of rows."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.expr("n_regionkey = r_regionkey")).selectExpr(
        "n_nationkey", "n_name AS genus", "r_name AS family"
    )


def _with_places(customers: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join nation and region to rows that carry the customer columns.

    One table is joined after the other. Spark then knows the size of every
    right side from its files, and broadcasts those that are small enough.
    """
    return customers.join(
        table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey")
    ).join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))


def _taxa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_places(table(spark, sf_dir, "customer"), spark, sf_dir).selectExpr(
        "c_custkey",
        "r_name AS family",
        "n_name AS genus",
        "concat(n_name, ' ', c_name) AS species",
    )


def _unrecorded_taxa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Species without records, to be labelled by genus, by family, or not at all."""
    supplier = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "c_nationkey")
    placed = _with_places(supplier, spark, sf_dir).selectExpr(
        "s_suppkey",
        "s_name",
        "CASE WHEN s_suppkey % 3 = 2 THEN concat(r_name, ' PROVINCE') ELSE r_name END AS family",
        "CASE WHEN s_suppkey % 3 = 0 THEN n_name ELSE concat('Supplied', n_nationkey) END AS genus",
    )
    return placed.selectExpr("s_suppkey", "family", "genus", "concat(genus, ' ', s_name) AS species")


def taxon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All species, and the genera and families of customers, as schema ``TAXON``."""
    places = _with_places(
        table(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey"), spark, sf_dir
    )
    region = table(spark, sf_dir, "region")
    parts = [
        _taxa(spark, sf_dir).selectExpr(
            "c_custkey AS taxon_id", "family", "genus", "species", "'species' AS taxon_rank"
        ),
        _unrecorded_taxa(spark, sf_dir).selectExpr(
            "500000000 + s_suppkey", "family", "genus", "species", "'species'"
        ),
        places.selectExpr(
            "CAST(1000000000 + n_nationkey AS BIGINT)",
            "r_name",
            "n_name",
            "CAST(NULL AS STRING)",
            "'genus'",
        ),
        region.selectExpr(
            "CAST(2000000000 + r_regionkey AS BIGINT)",
            "r_name",
            "CAST(NULL AS STRING)",
            "CAST(NULL AS STRING)",
            "'family'",
        ),
    ]
    return reduce(DataFrame.union, parts)


def _dealt(df: DataFrame, tasks: int | None, key: str) -> DataFrame:
    return df.repartition(tasks, key) if tasks else df


def _of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer.

    A customer table that one task can hold is left to Spark, to broadcast.
    """
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    tasks = tasks_for(spark, orders.count()) if customer.count() > TASK_ROWS else None
    return _dealt(orders, tasks, "o_custkey").join(
        _dealt(customer, tasks, "c_custkey"), F.expr("o_custkey = c_custkey")
    )


def _scrubbed(key: str) -> list[str]:
    """Genus and species of a record, missing for some keys."""
    return [
        f"CASE WHEN {key} % 50 != 0 THEN n_name END AS scrubbed_genus",
        f"CASE WHEN {key} % 50 != 0 AND {key} % 20 != 0 THEN concat(n_name, ' ', c_name) END"
        " AS scrubbed_species_binomial",
    ]


def trait_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trait table: per order a growth form, for some another trait as well."""
    orders = _with_places(_of_customers(spark, sf_dir), spark, sf_dir)

    def trait(rows: DataFrame, name: str, value: str) -> DataFrame:
        return rows.selectExpr(
            "o_orderkey AS id",
            f"CASE WHEN o_orderkey % 97 = 0 THEN '{UNKNOWN}' ELSE r_name END AS scrubbed_family",
            *_scrubbed("o_orderkey"),
            f"'{name}' AS trait_name",
            f"{value} AS trait_value",
            "r_name AS country",
            "n_name AS state_province",
            "c_name AS authorship",
            "c_mktsegment AS authorship_contact",
            "o_orderstatus AS citation_bibtex",
            "c_mktsegment AS project_pi",
            "CAST(o_orderkey % 2 AS SMALLINT) AS is_individual_trait",
            "CAST(1 - o_orderkey % 2 AS SMALLINT) AS is_species_trait",
        )

    dirty = """CASE o_orderkey % 7 WHEN 0 THEN concat('* ', o_orderpriority)
        WHEN 1 THEN concat(lower(o_orderpriority), ' ') ELSE o_orderpriority END"""
    growth_forms = trait(orders, GROWTH_FORM_TRAITS[0], dirty)
    some = orders.filter("o_orderkey % 10 = 0")
    return growth_forms.unionByName(trait(some, "plant status", "o_orderstatus"))


def observation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An occurrence table: one row per line item, some without a label.

    Orders meet their customers first, so that the line items, the longest
    table, are dealt out once, and to more tasks the more there are.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    tasks = tasks_for(spark, lineitem.count())
    lines = _dealt(lineitem, tasks, "l_orderkey").join(
        _dealt(_of_customers(spark, sf_dir), tasks, "o_orderkey"), F.expr("l_orderkey = o_orderkey")
    )
    return _with_places(lines, spark, sf_dir).selectExpr(
        "l_orderkey * 10 + l_linenumber AS taxonobservation_id",
        "CASE WHEN l_linestatus = 'O' THEN 'plot' ELSE 'specimen' END AS observation_type",
        "c_mktsegment AS datasource",
        f"CASE WHEN l_orderkey % 89 = 0 THEN '{UNKNOWN}' ELSE r_name END AS scrubbed_family",
        *_scrubbed("l_orderkey"),
        "CASE WHEN l_orderkey % 25 != 0 THEN concat(l_returnflag, l_linestatus) END AS growth_form",
    )


def traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributions ``id, family, genus, species, label`` of the traits."""
    return as_attributions(scan_traits(trait_records(spark, sf_dir)), "id", "trait_value")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributions ``id, family, genus, species, label`` of the observations."""
    records = scan_observations(observation_records(spark, sf_dir))
    return as_attributions(records, "taxonobservation_id", "growth_form")


def sparse_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traits with every fourth family missing, so that all NULLs occur."""
    return traits(spark, sf_dir).withColumn(
        "family", F.when(F.col("id") % 4 != 0, F.col("family"))
    )


def trait_vocab(spark: SparkSession) -> DataFrame:
    return lookup(spark, TRAIT_MEANINGS, VOCABULARY)


def observation_vocab(spark: SparkSession) -> DataFrame:
    return lookup(spark, OBSERVATION_MEANINGS, VOCABULARY)


def homonym_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every genus is flagged in the family Unknown, some without a family."""
    places = _places(spark, sf_dir)
    unknown = places.selectExpr(
        "genus",
        f"'{UNKNOWN}' AS family",
        "CAST(1 AS SMALLINT) AS is_homonym_genus",
        "CAST(n_nationkey % 2 AS SMALLINT) AS check_species",
    )
    nowhere = places.filter("n_nationkey % 8 = 1").selectExpr(
        "genus",
        "CAST(NULL AS STRING) AS family",
        "CAST(1 AS SMALLINT) AS is_homonym_genus",
        "CAST(0 AS SMALLINT) AS check_species",
    )
    return unknown.unionByName(nowhere)


def _rules(df: DataFrame, scope: str, **fields: str) -> DataFrame:
    """Rules of one scope; fields left out are NULL or false."""
    empty = {f.name: "false" if f.dataType == T.BooleanType() else "NULL" for f in NAME_RULES}
    values = empty | {"scope": f"'{scope}'"} | fields
    return df.selectExpr(
        *(f"CAST({values[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in NAME_RULES)
    )


def name_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted names for genera in Unknown; those of odd nations get none.

    Even nations return to their region, every second of them under another
    genus where the species is not known. Some species are renamed whatever
    their genus.
    """
    places = _places(spark, sf_dir)
    all_names = {f"set_{rank}": "true" for rank in RANKS}
    back = _rules(
        places.filter("n_nationkey % 2 = 0"),
        "genus_family",
        genus="genus",
        family=f"'{UNKNOWN}'",
        acc_family="family",
        acc_genus="genus",
        copy_species="true",
        track="true",
        **all_names,
    )
    other_genus = _rules(
        places.filter("n_nationkey % 4 = 2"),
        "genus_family_null_species",
        genus="genus",
        family=f"'{UNKNOWN}'",
        acc_family="family",
        acc_genus="concat(genus, '_ALT')",
        track="true",
        **all_names,
    )
    renamed = _rules(
        _taxa(spark, sf_dir).filter("c_custkey % 40 = 5"),
        "species",
        species="species",
        acc_species="concat(species, ' renamed')",
        set_species="true",
        track="true",
    )
    return back.unionByName(other_genus).unionByName(renamed)


def name_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule per fifth species: it leaves Unknown; every 35th is tracked."""
    return _rules(
        _taxa(spark, sf_dir).filter("c_custkey % 5 = 0"),
        "species_family",
        species="species",
        family=f"'{UNKNOWN}'",
        acc_family="family",
        set_family="true",
        track="c_custkey % 35 = 0",
    )


def taxon_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop what is known of some genera without a species."""
    return (
        _places(spark, sf_dir)
        .filter("n_nationkey % 5 = 2")
        .selectExpr("family", "genus", "'  ' AS species")
    )


def observation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of the observations; for some names they differ from the traits'."""
    return _rules(
        _places(spark, sf_dir).filter("n_nationkey % 2 = 0"),
        "genus_family",
        genus="genus",
        family=f"'{UNKNOWN}'",
        acc_family="family",
        acc_genus="CASE WHEN n_nationkey % 4 = 0 THEN concat('A_', genus) ELSE genus END",
        copy_species="true",
        track="true",
        **{f"set_{rank}": "true" for rank in RANKS},
    )


def overrides(spark: SparkSession) -> DataFrame:
    note = "corrected by hand"
    return lookup(
        spark,
        [
            ("ASIA", "vine", "vine", None, None, None, note),
            ("EUROPE", "hemiepiphyte", None, 25, Decimal("0.20"), None, note),
            ("MIDDLE EAST", "liana", "liana", None, Decimal("1.00"), True, note),
        ],
        OVERRIDES,
    )


def group_exclusions(spark: SparkSession) -> DataFrame:
    return lookup(spark, [("ASIA",), ("MIDDLE EAST",)], GROUP_EXCLUSIONS)


def species_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list to label: every species."""
    return target_species(taxon(spark, sf_dir)).drop("genus")


def species_list_with_old_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every species twice, once under its family and once under Unknown."""
    current = species_list(spark, sf_dir)
    return current.unionByName(current.withColumn("family", F.lit(UNKNOWN)))

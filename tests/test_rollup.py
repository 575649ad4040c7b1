"""The roll-up in one pass, exact counts by bitmaps, homonyms by hashes, imports."""

import fixtures
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_scale import plan, settings

from traitvote import operators as op
from traitvote.schemas import NAME_RULES, VOCABULARY
from traitvote.sources import import_curated, import_vocab


@pytest.fixture
def counts(spark, table, stages):
    extra = table(
        fixtures.NAMES + ", gf string, obs bigint",
        ("E", "G", None, "vine", 5), ("E", "G", "G a", "tree", 1), ("E", None, "lost x", "herb", 2),
        ("E", "H", "H a", None, 3), (None, "G", "G q", "tree", 7),
    )
    return stages.write("counts", op.merge_counts(fixtures.counts(table) | {"extra": extra}))


@pytest.mark.parametrize("double", [True, False])
def test_all_ranks_from_one_shuffle(spark, counts, stages, double):
    rolled = op.roll_up(counts, double)
    assert plan(rolled).count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan(rolled) and "ObjectHashAggregate" not in plan(rolled)
    written = stages.write("rolled", rolled)
    assert rows(op.genus_votes(written)) == rows(op.genus_obs(counts))
    assert rows(op.family_votes(written)) == rows(op.family_obs(counts, double))
    assert "Exchange hashpartitioning" not in plan(op.genus_votes(written))
    assert "Exchange" not in plan(op.family_votes(written))


def test_the_roll_up_counts_before_it_shuffles_a_hot_genus(spark, stages):
    hot = spark.range(90_000).selectExpr(
        "'F' AS family", "IF(id % 3 = 0, 'G', concat('G', id)) AS genus", "concat('s', id) AS species",
        "'tree' AS gf", "id AS obs", "'x' AS obs_sources",
    )
    written = stages.write("counts", hot)
    rolled = stages.write("rolled", op.roll_up(written))
    got = {(r.family, r.genus): r.obs for r in op.genus_votes(rolled).filter("genus = 'G'").collect()}
    assert got == {("F", "G"): sum(range(0, 90_000, 3))}
    assert rolled.count() == 60_001 + 1


# --- Bitmaps -------------------------------------------------------------------------


def listed(table, *names):
    return table(fixtures.NAMES, *names)


def test_bitmaps_of_batches_count_distinct_species(table, stages):
    first = listed(table, ("F", "G", "G a"), ("F", "G", "G b"), ("F", "H", "H a"), ("F", "H", None))
    second = listed(table, ("F", "G", "G b"), ("F", "G", "G c"), ("E", "G", "G a"), (None, None, "x"))
    numbers = op.number_species(first, stages)
    one = stages.write("one", op.species_bitmaps(first, numbers))
    later = op.number_species(second, stages, numbers)
    given = dict(rows(numbers))
    assert sorted(given.values()) == [1, 2, 3] and given.items() <= dict(rows(later)).items()
    assert sorted(dict(rows(later)).values()) == [1, 2, 3, 4, 5]
    merged = op.merge_bitmaps(one, op.species_bitmaps(second, later))
    both = first.unionByName(second).filter("species IS NOT NULL")
    wanted = [
        (rank, r[0], r[1])
        for rank in ("genus", "family")
        for r in both.groupBy(rank).agg(F.count_distinct("species")).collect()
    ]
    assert rows(op.count_species(merged), "rank", "taxon", "spp") == sorted(wanted, key=repr)


def test_a_genus_in_several_bitmaps(spark, stages):
    many = spark.range(70_000).selectExpr("'F' AS family", "'G' AS genus", "concat('G ', id) AS species")
    numbers = op.number_species(many, stages)
    maps = stages.write("maps", op.species_bitmaps(many.unionByName(many), numbers))
    assert maps.filter("rank = 'genus'").count() == 3
    assert rows(op.count_species(op.merge_bitmaps(maps, maps))) == [("family", "F", 70_000), ("genus", "G", 70_000)]


def test_both_ranks_come_from_one_scan(table, stages):
    taxa = stages.write("taxa", listed(table, ("F", "G", "G a"), ("F", "H", "H a")))
    text = plan(op.species_bitmaps(taxa, op.number_species(taxa, stages)))
    assert text.count("FileScan") == 2 and text.count("Expand") == 1  # the rows and their numbers


def test_no_species_no_bitmaps(table, stages):
    nothing = listed(table)
    numbers = op.number_species(nothing, stages)
    assert op.count_species(op.species_bitmaps(nothing, numbers)).count() == 0
    assert op.number_species(listed(table, ("F", "G", "G a")), stages, numbers).first()["number"] == 1


# --- Homonyms ------------------------------------------------------------------------


def shuffled(df):
    """Bytes that the last execution of ``df`` wrote to its shuffles."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan().finalPhysicalPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            node = node.plan()
        metrics = node.metrics()
        if metrics.contains("shuffleBytesWritten"):
            total += metrics.apply("shuffleBytesWritten").value()
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return total


def test_only_pairs_of_homonyms_are_shuffled(spark, stages):
    many = spark.range(60_000).selectExpr(
        "IF(id < 3, 'Twice', md5(string(id))) AS genus",
        "CASE WHEN id = 2 THEN NULL ELSE concat('family of a long name', id % 50) END AS family",
    )
    rows_of = stages.write("rows", many)
    plain = op.homonym_pairs(rows_of, "genus")
    lean = op.homonym_pairs(rows_of, "genus", write=stages.keep("names"))
    assert rows(lean, "genus", "family") == rows(plain, "genus", "family")
    assert len(rows(lean)) == 3
    assert shuffled(lean) * 100 < shuffled(plain)
    names = op.homonym_names(rows_of, "genus")
    text = plan(names)
    assert "SortAggregate" not in text and text.count("Exchange hashpartitioning") == 1


# --- Imports ---------------------------------------------------------------------------


def test_all_wrong_lines_of_a_vocabulary_are_told(spark, stages, tmp_path):
    (tmp_path / "v.csv").write_text(
        "gf_verbatim,gf,is_woody,substrate,other,is_useless\n"
        "tree,tree,1,,,0\n"
        "tree,tree,1,,,0\n"  # twice the same
        "shrub,shrub,1,,,0\n"
        '"a ""b"", c",herb,0,,"two\nlines",0\n'
        "fern,herb,maybe,,,0\n"  # no number
        "moss,herb,0,,0\n"  # too few
        "reed,herb,0,,,0,9\n"  # too many
        ",tree,1,,,0\n"  # no label
        '"  ",tree,1,,,0\n'
        "vine,vine,0,,,0\n"  # two meanings
        "vine,liana,1,,,0\n"
    )
    got = import_vocab(spark, str(tmp_path / "v.csv"), stages)
    assert got.rows.columns == VOCABULARY.names
    assert rows(got.rows, "gf_verbatim", "gf", "is_woody", "other") == sorted(
        [("tree", "tree", 1, None), ("shrub", "shrub", 1, None), ('a "b", c', "herb", 0, "two\nlines")], key=repr
    )
    refused = rows(got.refused, "reason", "line")
    assert [(reason, line.split(",")[0]) for reason, line in refused] == [
        ("conflict", "vine"), ("conflict", "vine"), ("malformed", "fern"), ("malformed", "moss"),
        ("malformed", "reed"), ("no key", "  "), ("no key", ""),
    ]
    assert {r.file for r in got.refused.collect()} == {"v.csv"}
    # and a build can use what is left
    assert rows(op.apply_vocab(spark.sql("SELECT 'shrub' AS label, 1 AS n"), got.rows), "gf_std") == [("shrub",)]


def test_other_tables_by_other_keys(spark, stages, tmp_path):
    header = ",".join(NAME_RULES.names)
    (tmp_path / "r.csv").write_text(
        f"{header}\ngenus,,G,,,H,,true,true,false,false,true\ngenus,,G,,,K,,true,true,false,false,true\n"
        "species,,,G a,,,G b,false,false,true,false,true\n"
    )
    key = ["scope", "family", "genus", "species"]
    got = import_curated(spark, str(tmp_path / "r.csv"), NAME_RULES, key, stages)
    assert rows(got.rows, "scope", "acc_species") == [("species", "G b")]
    assert [r.reason for r in got.refused.collect()] == ["conflict"] * 2


def test_an_empty_file_has_no_lines(spark, stages, tmp_path):
    (tmp_path / "v.csv").write_text(",".join(VOCABULARY.names) + "\n")
    got = import_vocab(spark, str(tmp_path / "v.csv"), stages)
    assert got.rows.count() == got.refused.count() == 0


def test_metrics_of_the_rows_cost_no_job(spark, table, stages, tmp_path):
    from test_resume import jobs_of

    df = stages.write("in", table(fixtures.NAMES + ", n bigint", ("F", "G", None, 2), (None, None, None, 3)))
    _, plainly = jobs_of(spark, "plainly", lambda: stages.write("x", df))
    _, observed = jobs_of(spark, "observed", lambda: stages.write("y", df, metrics=op.row_metrics()))
    assert observed == plainly
    assert stages.observed["y"] == {"rows": 2, "records": 5, "unplaced": 1}
    with settings(spark, shuffle__partitions="2"):
        assert rows(op.check_rank_assigned(df)) == [(False,)]

"""Tables in an order: pages, places, running sums; tables by key; trait folders."""

import re

import fixtures
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_scale import plan, settings

from traitvote import operators as op
from traitvote.sources import read_traits, write_keyed, write_ordered, write_traits
from traitvote.sources import sizes
from traitvote.starschema import adapter

SF_DIR = "/root/testdata/sf0.001"


def test_pages_read_only_the_partitions_they_are_in(spark, stages):
    shuffled = spark.range(5000).selectExpr("id", "pmod(hash(id), 100) AS h", "repeat('x', 50) AS s")
    with settings(spark, shuffle__partitions="16", adaptive__coalescePartitions__enabled="false"):
        ordered = write_ordered(shuffled, F.desc("h"), "id", stages=stages, name="t")
    wanted = sorted(((r.id, r.h, r.s) for r in shuffled.collect()), key=lambda r: (-r[1], r[0]))
    assert ordered.parts.count() > 8
    for limit, offset in ((25, 0), (25, 3400), (700, 900), (10, 4995), (10, 6000), (0, 5)):
        page = ordered.page(limit, offset)
        assert [tuple(r) for r in page.collect()] == wanted[offset : offset + limit]
    page = ordered.page(25, 3400)
    assert re.search(r"PartitionFilters: \[[^\]]*__part", plan(page))
    assert files_read(page) <= 2 < files_read(ordered.rows)


def files_read(df):
    """Files that the scans of an execution of ``df`` opened."""
    df.collect()
    plan_ = df._jdf.queryExecution().executedPlan()
    todo, total = [plan_], 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.finalPhysicalPlan()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            node = node.plan()
        if node.metrics().contains("numFiles"):
            total += node.metrics().apply("numFiles").value()
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return total


def test_many_equal_keys_spread_over_partitions(spark, stages):
    same = spark.range(4000).selectExpr("1 AS k", "id")
    with settings(spark, shuffle__partitions="8", adaptive__coalescePartitions__enabled="false"):
        ordered = write_ordered(same, "k", stages=stages, name="t")
    assert max(r.n for r in ordered.parts.collect()) < 2000
    assert sorted(r.at for r in ordered.numbered("at").collect()) == list(range(4000))


def test_more_rows_get_more_partitions(spark, stages, monkeypatch):
    """However few partitions the session asks for, and however small they are as files."""
    monkeypatch.setattr(sizes, "TASK_ROWS", 1000)
    with settings(spark, shuffle__partitions="2"):
        ordered = write_ordered(spark.range(20_000), F.desc("id"), stages=stages, name="t")
    counts = [r.n for r in ordered.parts.collect()]
    assert len(counts) >= 15 and max(counts) < 3000
    assert [r.id for r in ordered.page(3, 12_345).collect()] == [7654, 7653, 7652]


def test_running_sums(spark, stages):
    ordered = write_ordered(spark.range(1, 1001), F.desc("id"), stages=stages, name="t")
    found = {r.id: (r.total, r.n) for r in ordered.running(total="id", n=F.lit(1)).collect()}
    total = 0
    for n, k in enumerate(range(1000, 0, -1), 1):
        total += k
        assert found[k] == (total, n)


def test_an_empty_table_in_order(spark, stages):
    ordered = write_ordered(spark.range(0), "id", stages=stages, name="t")
    assert ordered.page(5).count() == ordered.numbered("at").count() == ordered.running(s="id").count() == 0


def test_a_deep_page_is_the_same_as_a_plain_one(spark, stages):
    df = adapter.observations(spark, SF_DIR)
    order = [op.epithet(), "species", "id", "label"]
    for offset in (0, 3400):
        plain = op.inspect_page(df, *order, limit=25, offset=offset)
        deep = op.inspect_page(df, *order, limit=25, offset=offset, stages=type(stages)(spark, stages.path))
        assert [tuple(r) for r in deep.collect()] == [tuple(r) for r in plain.collect()]


# --- Tables by key -----------------------------------------------------------------


@pytest.fixture
def keyed(spark, table, stages):
    species, genus, family = fixtures.consensus(table)
    listed = spark.range(2000).selectExpr(
        "id",
        "'F' AS family",
        "CASE id % 4 WHEN 0 THEN 'G a' WHEN 1 THEN NULL ELSE concat('G ', id) END AS species",
    )
    known = stages.write_bucketed("species", species, "species", 4)
    return listed, write_keyed(listed, "species", 4, stages, "list", 100), known, genus, family


def test_a_keyed_list_is_joined_where_it_lies(spark, stages, keyed):
    listed, by_key, known, genus, family = keyed
    assert rows(by_key.hot) == [("G a",)]
    assert (by_key.rows.count(), by_key.apart.count()) == (1000, 1000)
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        text = plan(op.impute(by_key.rows, known))
        assert "SortMergeJoin" in text and "Exchange" not in text
        done = op.impute_keyed(by_key, known, genus, family)
        assert rows(done) == rows(op.impute(listed, known, genus, family))


def test_bucketed_tables_leave_the_catalogue_with_their_stages(spark, stages, keyed):
    before = {t.name for t in spark.catalog.listTables()}
    stages.delete()
    gone = before - {t.name for t in spark.catalog.listTables()}
    assert len(gone) == 2 and all(name.startswith("traitvote_") for name in gone)


# --- Folders -----------------------------------------------------------------------


def test_only_the_folders_of_wanted_traits_are_opened(spark, tmp_path):
    path = str(tmp_path / "traits")
    records = adapter.trait_records(spark, SF_DIR)
    write_traits(records, path)
    found = read_traits(spark, path)
    text = plan(found)
    assert re.search(r"PartitionFilters: \[[^\]]*trait_name", text)
    assert "PushedFilters: []" in text
    assert {r.trait_name for r in records.select("trait_name").distinct().collect()} == {
        "whole plant growth form", "plant status",
    }
    names = {r[0] for r in found.select(F.input_file_name()).distinct().collect()}
    assert names and all("growth" in name for name in names)
    assert rows(found) == rows(records.filter("trait_name = 'whole plant growth form'"))

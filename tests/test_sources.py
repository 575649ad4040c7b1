import csv
import re
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import expect, rows

from traitvote import Stages
from traitvote.schemas import NAME_RULES, OBSERVATIONS, TRAITS, VOCABULARY
from traitvote.sources import (
    read_curated,
    read_observations,
    read_traits,
    read_vocab,
    write_vocab,
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def trait_file(spark, table, tmp_path):
    df = table(
        TRAITS,
        *(
            (i, "F", "G", "G a", name, "tree", None, None, None, None, None, None, 1, 0)
            for i, name in enumerate(
                ["whole plant growth form", "whole plant growth form diversity", "height"]
            )
        ),
    )
    path = str(tmp_path / "traits")
    df.selectExpr("*", "'unused' AS extra").write.parquet(path)
    return path


def test_traits_are_filtered_in_the_scan(spark, trait_file):
    df = read_traits(spark, trait_file)
    assert df.columns == TRAITS.names
    assert [r[0] for r in rows(df, "id")] == [0]
    assert "PushedFilters: [IsNotNull(trait_name), EqualTo(trait_name,whole plant" in plan(df)
    both = read_traits(spark, trait_file, ["height", "whole plant growth form"])
    assert [r[0] for r in rows(both, "id")] == [0, 2]
    assert "In(trait_name" in plan(both)


def test_scan_reads_only_the_columns_that_are_used(spark, trait_file):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(read_traits(spark, trait_file).select("id")))
    assert schema[1] == "id:bigint,trait_name:string"


def test_observations_without_label_are_skipped_in_the_scan(spark, table, tmp_path):
    path = str(tmp_path / "observations")
    table(
        OBSERVATIONS,
        (1, "plot", "d", "F", "G", "G a", "tree"),
        (2, "plot", "d", "F", "G", "G a", None),
    ).write.parquet(path)
    df = read_observations(spark, path)
    assert [r[0] for r in rows(df, "taxonobservation_id")] == [1]
    assert "PushedFilters: [IsNotNull(growth_form)]" in plan(df)


def test_stages_use_the_shared_folder_of_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = Stages(spark).path
    assert path != Stages(spark).path
    assert shared is None or path.startswith(shared)


def without_shared_folder(master: str, checkpoints: str | None = None):
    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoints)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_a_cluster_has_to_name_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        Stages(without_shared_folder("yarn"))
    assert Path(Stages(without_shared_folder("local[2]")).path).parent.is_dir()
    set_later = Stages(without_shared_folder("yarn", "hdfs:/shared"))
    assert set_later.path.startswith("hdfs:/shared/")


def test_stages_can_be_deleted(spark, table, tmp_path):
    with Stages(spark, str(tmp_path)) as stages:
        stages.write("one", table("a int", (1,)))
        stages.keep("many")(table("a int", (1,)))
        assert Path(stages.path, "many_0").is_dir()
    assert not Path(stages.path).exists()
    Stages(spark, str(tmp_path)).delete()


def test_stages_write_once(table, stages):
    df = table("a string, b int", ("x", 1), (None, None))
    written = stages.write_all({"one": df, "two": df.limit(0)})
    assert rows(written["one"]) == rows(df)
    assert written["two"].columns == ["a", "b"] and written["two"].count() == 0
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        stages.write("one", df)
    assert stages.write_all({}) == {}


def test_curated_tables_are_csv(spark, tmp_path):
    file = tmp_path / "rules.csv"
    file.write_text(
        ",".join(NAME_RULES.names) + "\n"
        "species,,,A b,F,A,A c,true,true,true,false,true\n"
    )
    expect(
        read_curated(spark, str(file), NAME_RULES),
        " ".join(NAME_RULES.names),
        ("species", None, None, "A b", "F", "A", "A c", True, True, True, False, True),
    )


AWKWARD = ["\ttree", 'a "b" c', 'say "x", y', "two\nlines", " leading", "trailing ", "back\\slash"]


def test_labels_survive_our_own_file(spark, table, tmp_path):
    vocab = table(VOCABULARY, *((w, None, None, None, None, 0) for w in AWKWARD))
    write_vocab(vocab, str(tmp_path / "vocab"))
    assert rows(read_vocab(spark, str(tmp_path / "vocab"))) == rows(vocab)


def test_labels_survive_a_standard_file(spark, tmp_path):
    file = tmp_path / "vocab.csv"
    with file.open("w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(VOCABULARY.names)
        writer.writerows([(w, "tree", 1, "", "", 0) for w in AWKWARD])
    expect(
        read_vocab(spark, str(file)),
        " ".join(VOCABULARY.names),
        *((w, "tree", 1, None, None, 0) for w in AWKWARD),
    )


def test_columns_in_another_order_are_refused(spark, tmp_path):
    file = tmp_path / "vocab.csv"
    file.write_text("gf,gf_verbatim,is_woody,substrate,other,is_useless\ntree,tree,1,,,0\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_vocab(spark, str(file)).collect()

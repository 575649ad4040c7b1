"""Runs that are broken off and started again."""

import json
from pathlib import Path

import fixtures
import pytest
from conftest import rows
from pyspark.sql import functions as F

from traitvote import Source, build, prepare
from traitvote.schemas import VOCABULARY
from traitvote.sources import ResumableStages
from traitvote.sources.resume import fingerprint

NAMES = fixtures.NAMES + ", label string"


def jobs_of(spark, group, action):
    """What ``action`` returns, and how many jobs it started."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = action()
        return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("others", "others")


@pytest.fixture
def inputs(spark, table, tmp_path):
    """Two sources, a vocabulary and a taxon table as files."""
    files = {
        "traits": table(NAMES, ("F", "G", "G a", "tree"), ("F", "G", "G a", "tree"), ("F", "G", None, "herb")),
        "others": table(NAMES, ("F", "G", "G b", "herb"), ("E", "G", "G b", "tree")),
        "vocab": table(VOCABULARY, ("tree", "tree", 1, None, None, 0), ("herb", "herb", 0, None, None, 0)),
        "taxon": fixtures.taxon(table),
    }
    for name, df in files.items():
        df.write.parquet(f"{tmp_path}/{name}")

    def read(name):
        return spark.read.schema(files[name].schema).parquet(f"{tmp_path}/{name}")

    return read


def sources(read):
    return {n: Source(read(n), read("vocab")) for n in ("traits", "others")}


def results(built):
    return {n: rows(getattr(built, n)) for n in ("species", "genus", "family", "counts", "checks")}


def test_a_build_goes_on_after_its_preparation(spark, inputs, tmp_path):
    def stages():
        return ResumableStages(spark, "nightly", str(tmp_path / "shared"))

    first, n_first = jobs_of(spark, "a", lambda: prepare(sources(inputs), stages()))
    again, n_again = jobs_of(spark, "b", lambda: prepare(sources(inputs), stages()))
    assert n_first > 0 and n_again == 0
    assert again.observed == first.observed
    assert first.observed["traits"] == {"rows": 2, "records": 3, "unplaced": 0}

    built, n_rest = jobs_of(spark, "c", lambda: build(sources(inputs), inputs("taxon"), stages()))
    done, n_none = jobs_of(spark, "d", lambda: build(sources(inputs), inputs("taxon"), stages()))
    assert n_rest > 0 and n_none == 0
    plain = build(sources(inputs), inputs("taxon"), ResumableStages(spark, "other", str(tmp_path / "shared")))
    assert results(built) == results(done) == results(plain)


def test_a_changed_input_is_computed_again_and_nothing_else(spark, table, inputs, tmp_path):
    def run():
        stages = ResumableStages(spark, "run", str(tmp_path / "shared"))
        return build(sources(inputs), inputs("taxon"), stages), stages

    before, stages = run()
    old = set(stages._used)
    table(NAMES, ("F", "G", "G b", "tree"), ("F", "G", "G b", "tree")).write.mode("append").parquet(
        f"{tmp_path}/others"
    )
    after, stages = run()
    assert rows(after.species, "species", "gf_cons") == [("G a", "tree"), ("G b", "tree")]
    assert results(before) != results(after)
    kept = {name.rsplit("-", 1)[0] for name in stages._used & old if not name.endswith(".json")}
    assert "traits_rows" in kept and "others_rows" not in kept and "species" not in kept
    stages.prune()  # what only the first run used is gone, what this one used is there
    assert set(stages._used) - {"_records"} == {
        p.name for p in [*Path(stages.path).iterdir(), *(Path(stages.path) / "_records").glob("*.json")]
    } - {"_records"}
    assert results(run()[0]) == results(after)


class Killed(Exception):
    pass


def test_a_run_killed_while_it_writes_leaves_nothing_wrong(spark, table, tmp_path, monkeypatch):
    table("k int", *((i,) for i in range(20))).write.parquet(f"{tmp_path}/in")
    root = str(tmp_path / "shared")

    def work(stages):
        first = stages.write("first", spark.read.schema("k int").parquet(f"{tmp_path}/in").filter("k > 3"))
        return stages.write("second", first.selectExpr("k * 2 AS k"))

    broken = ResumableStages(spark, "r", root)
    record = ResumableStages._write_record

    def dies(self, key, found):
        if found["name"] == "second":  # its table is there, but nothing says it is whole
            raise Killed
        record(self, key, found)

    monkeypatch.setattr(ResumableStages, "_write_record", dies)
    with pytest.raises(Killed):
        work(broken)
    monkeypatch.undo()
    stages = ResumableStages(spark, "r", root)
    assert stages.finished() == ["first"]
    assert sorted(r.k for r in work(stages).collect()) == [k * 2 for k in range(4, 20)]
    assert stages.finished() == ["first", "second"]
    folders = sorted(p.name for p in Path(stages.path).iterdir() if p.name.startswith("second"))
    assert len(folders) == 2
    stages.prune()
    assert sum(p.name.startswith("second") for p in Path(stages.path).iterdir()) == 1
    # a table that lost a file does not count as finished
    found = [json.loads(p.read_text()) for p in (Path(stages.path) / "_records").glob("*.json")]
    first = next(record["table"] for record in found if record["name"] == "first")
    next((Path(stages.path) / first).glob("part-*.parquet")).unlink()
    assert len(rows(work(ResumableStages(spark, "r", root)))) == 16


def test_versions_and_parameters_are_told_apart(spark, table, tmp_path):
    table("k int, s string", (1, "a"), (2, "b")).write.parquet(f"{tmp_path}/in")

    def read(schema="k int, s string"):
        return spark.read.schema(schema).parquet(f"{tmp_path}/in")

    same = fingerprint(read().filter("k > 1").withColumn("u", F.transform(F.split("s", "x"), lambda w: F.upper(w))))
    assert same == fingerprint(
        read().filter("k > 1").withColumn("u", F.transform(F.split("s", "x"), lambda w: F.upper(w)))
    )
    others = [
        read().filter("k > 2"), read().filter("k >= 1"), read("s string, k int"), read("k int, t string"),
        read().selectExpr("k AS s", "s AS k"), read().join(read().toDF("k2", "s2"), F.expr("k = k2")),
        read().join(read().toDF("k2", "s2"), F.expr("k = k2"), "left"),
    ]
    assert len({fingerprint(df) for df in others}) == len(others)
    in_memory = [spark.sql(f"SELECT * FROM VALUES ({k}) AS t(k)") for k in (1, 2)]
    assert len({fingerprint(df) for df in in_memory}) == 2
    assert fingerprint(table("k int", (1,))) is None  # rows that Python made
    assert fingerprint(read().mapInPandas(lambda batches: batches, "k int, s string")) is None

    def jobs(version, group):
        stages = ResumableStages(spark, "v", str(tmp_path / "shared"), version)
        return jobs_of(spark, group, lambda: stages.write("t", read()))[1]

    assert jobs("1", "v1") > 0 and jobs("1", "v2") == 0 and jobs("2", "v3") > 0


def test_rows_made_by_python_are_written_each_time(spark, table, tmp_path):
    stages = ResumableStages(spark, "p", str(tmp_path / "shared"))
    made = table("k int", (1,)).mapInPandas(lambda batches: batches, "k int")
    assert rows(stages.write("t", made, metrics={"n": F.count(F.lit(1))})) == [(1,)]
    assert stages.observed["t"] == {"n": 1} and stages.finished() == []
    assert rows(stages.write("t", made)) == [(1,)]


def test_the_same_work_under_two_names_at_once(spark, table, tmp_path):
    table("k int", (1,), (2,)).write.parquet(f"{tmp_path}/in")
    stages = ResumableStages(spark, "two", str(tmp_path / "shared"))
    df = spark.read.schema("k int").parquet(f"{tmp_path}/in")
    both = stages.write_all({"a": df, "b": df})
    assert rows(both["a"]) == rows(both["b"]) == [(1,), (2,)]
    assert len(stages.finished()) == 1

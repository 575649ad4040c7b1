import pytest
from conftest import expect, rows

from traitvote import operators as op
from traitvote.schemas import VOCABULARY
from traitvote.sources import read_vocab, write_list, write_vocab


@pytest.fixture(scope="module")
def vocab(table):
    return table(
        VOCABULARY,
        ("tree", "tree", 1, " terrestrial", "", 0),
        ("junk", None, None, None, None, 1),
        ("odd", None, None, None, None, None),
        ("blank", " ", None, " ", "x", 0),
    )


@pytest.fixture(scope="module")
def labels(table):
    return table("label string", ("tree",), ("junk",), ("odd",), ("blank",), ("unseen",), (None,))


def test_standardize(labels, vocab):
    expect(
        op.standardize(labels, vocab),
        "gf_verbatim gf_std is_woody substrate other is_useless",
        ("tree", "tree", 1, " terrestrial", None, 0),
        ("odd", None, None, None, None, None),
        ("blank", None, None, None, "x", 0),
        ("unseen", None, None, None, None, 0),
        (None, None, None, None, None, 0),
    )


def test_label_listed_twice_counts_once(labels, vocab):
    twice = vocab.unionAll(vocab).unionAll(vocab.filter("gf = 'tree'").withColumn("gf", vocab.other))
    assert op.apply_vocab(labels, twice).count() == labels.count()


def test_export_edit_import(spark, table, tmp_path):
    labels = table("label string", ("b, with comma",), ("a",), ('quoted "c"',), ("a",))
    exported = op.verbatim_vocab(labels)
    assert exported.schema == VOCABULARY or [f.dataType for f in exported.schema] == [
        f.dataType for f in VOCABULARY
    ]
    path = str(tmp_path / "vocab")
    write_vocab(exported, path)
    files = list((tmp_path / "vocab").glob("*.csv"))
    assert len(files) == 1, "a short vocabulary is one file"
    lines = files[0].read_text().splitlines()
    assert lines[0] == "gf_verbatim,gf,is_woody,substrate,other,is_useless"
    assert lines[1].startswith("a,")
    assert rows(read_vocab(spark, path)) == rows(exported)

    edited = tmp_path / "edited.csv"
    edited.write_text(lines[0] + '\na,tree,1,"terrestrial",,0\nb,,,,,1\n')
    expect(
        read_vocab(spark, str(edited)),
        " ".join(VOCABULARY.names),
        ("a", "tree", 1, "terrestrial", None, 0),
        ("b", None, None, None, None, 1),
    )


def test_import_fails_on_rows_that_do_not_fit(spark, tmp_path):
    edited = tmp_path / "edited.csv"
    edited.write_text("gf_verbatim,gf,is_woody,substrate,other,is_useless\na,tree,yes,,,0\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_vocab(spark, str(edited)).collect()


def test_list_is_written_with_header(table, tmp_path):
    path = tmp_path / "list"
    write_list(table("family string, species string", ("F", "G a")).coalesce(1), str(path))
    (file,) = path.glob("*.csv")
    assert file.read_text().splitlines() == ["family,species", "F,G a"]

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def stages(spark, tmp_path):
    from traitvote import Stages

    return Stages(spark, str(tmp_path / "stages"))


@pytest.fixture(scope="session")
def table(spark):
    """Make a table from a schema string and tuples."""

    def make(schema, *rows) -> DataFrame:
        return spark.createDataFrame(list(rows), schema)

    return make


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """The rows of the given columns in an order of their own."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)


def expect(df: DataFrame, columns: str, *expected: tuple) -> None:
    assert rows(df, *columns.split()) == sorted(expected, key=repr)

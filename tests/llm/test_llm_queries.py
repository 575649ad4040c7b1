"""Every text query against its SQL twin, and the shape of native plans."""

from __future__ import annotations

import duckdb
import pytest
from conftest import TESTDATA
from test_queries import in_order

import __spark_entry__ as entry_point
from traitvote.llm import ORACLES, QUERIES

SF_DIR = TESTDATA / "sf0.001"


def test_all_are_registered():
    queries = entry_point.queries()
    assert set(QUERIES) | {"pipeline"} <= set(queries)
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in queries) == 1
    assert set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, name):
    duck = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        duck.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df, wanted = QUERIES[name](spark, str(SF_DIR)), duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(wanted.columns)
    assert in_order(df.columns, df.collect()) == in_order(wanted.columns, wanted.fetchall())

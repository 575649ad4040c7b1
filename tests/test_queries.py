"""Every query against its SQL twin, and the shape of its plan."""

import re

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry_point
from traitvote.starschema import ORACLES, QUERIES

SF_DIR = TESTDATA / "sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def in_order(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in values), key=repr)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(SF_DIR))
    wanted = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(wanted.columns)
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR",
        "double": "DOUBLE", "boolean": "BOOLEAN",
    }
    got_types = {f.name: kinds.get(t := f.dataType.simpleString(), t.upper()) for f in df.schema}
    assert got_types == dict(zip(wanted.columns, (str(t) for t in wanted.types), strict=True))
    got = df.collect()
    assert in_order(df.columns, got) == in_order(wanted.columns, wanted.fetchall())
    assert got, "an empty result proves nothing"

    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|InPandas", plan)

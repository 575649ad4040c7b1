from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = "doc_id bigint, text string"

#: A table with every hard case: NULLs, empty and blank texts, repeats, clashing names.
CLASHES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        *(
            T.StructField(name, T.StringType())
            for name in (
                "lang", "source", "n_words", "n_lines", "kept", "score", "shard", "hs", "n", "bucket",
                "node", "key", "weight", "value", "h", "quality", "labels", "word",
            )
        ),
    ]
)


@pytest.fixture
def docs(table):
    return lambda *rows: table(DOCS, *rows)


@pytest.fixture
def hard(spark):
    """Documents with hard cases; ``extra`` adds (doc_id, text) rows."""

    def make(*extra):
        rest = (None,) * (len(CLASHES.fields) - 2)
        rows = [
            (1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (None, "no id at all"),
            (None, None), (5, "word " * 30_000), *extra,
        ]
        return spark.createDataFrame([(*row, *rest) for row in rows], CLASHES)

    return make


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], CLASHES)


def fresh(stages):
    """Another folder for stage tables."""
    return type(stages)(stages._spark, stages.path)

from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        # names that operators use themselves
        T.StructField("score", T.StringType()),
        T.StructField("fp", T.StringType()),
        T.StructField("rid", T.StringType()),
        T.StructField("ids", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, clashing column names."""
    words = " ".join(f"word{i % 997}x{i % 13}" for i in range(30_000))
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (None, "a text whose id is null"),
        (None, None),
        (4, "one"),
        (5, "The quick brown fox jumps over the lazy dog"),
        (5, "The quick brown fox jumps over the lazy dog"),
        (6, words),
        (7, words + " end"),
        (8, "été naïve 中文 😀 \x00 \x0b mixed"),
    ]
    return spark.createDataFrame([(i, t, "s", "f", "r", "i") for i, t in rows], DOCS)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)

from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        # Names that operators use for columns of their own.
        T.StructField("score", T.DoubleType()),
        T.StructField("n", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("key", T.StringType()),
    ]
)

LONG = " ".join(f"word{i % 977} tail{i}" for i in range(20_000))


@pytest.fixture(scope="session")
def awkward(spark):
    """NULLs in every column, empty and very long texts, ties and repeated rows, clashing names."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog.", "en", "a"),
        (1, "The quick brown fox jumps over the lazy dog.", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "b"),
        (4, " \t\n", "fr", "b"),
        (5, LONG, "en", "a"),
        (6, "le renard brun saute par dessus le chien paresseux", "fr", None),
        (None, "the quick brown fox jumps over the lazy dog", None, "b"),
        (8, "THE QUICK BROWN FOX JUMPS OVER THE LAZY DOG.", "en", "a"),
        (9, "x", "fr", "b"),
        (10, "one \u0000 two ünïcödé 漢字 🙂 <|endoftext|> it's 3.14", "en", "c"),
    ]
    return spark.createDataFrame([(*r, 0.5, "n", "row", "key") for r in rows], DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    schema = "doc_id long, quality int, toxic int, score double"
    return spark.createDataFrame([(1, 1, 0, 0.0), (5, None, None, 0.0), (8, 0, 1, 0.0), (None, 1, 1, 0.0)], schema)

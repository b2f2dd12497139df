import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text) as a table like ``documents``."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"word{i % 997} and, some more {i}." for i in range(20_000))
    return [
        (1, "The quick brown fox jumps over the lazy dog near the river bank."), (2, None), (3, ""), (4, "   \n\t "), (5, long), (6, long + " the end"), (None, "No id here, but text."),
        (7, "É à ü ß 日本語 テキスト 😀 ok"), (8, "a"), (8, "a"), (9, "The quick brown fox jumps over the lazy dog near the river bank."), (None, None), (10, "la " * 500),
    ]

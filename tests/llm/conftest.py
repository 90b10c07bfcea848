import os

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()),
    T.StructField("size", T.StringType()), T.StructField("comp", T.StringType())])


SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _row(key, text, lang="en", source="a"):
    return key, text, lang, source, None if text is None else len(text), "x", "y", "z"


ENGLISH = "the house on the hill was old and the people of the town were afraid of it in the night "
GERMAN = "das haus auf dem berg war alt und die leute der stadt hatten angst vor ihm in der nacht "
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(40_000))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, repeated rows, ties and columns whose names operators use themselves."""
    rows = [_row(1, None), _row(2, ""), _row(3, " \n\t "), _row(4, "a"), _row(5, ENGLISH * 3), _row(6, ENGLISH * 3),
            _row(7, GERMAN * 3, "de", "b"), _row(8, GERMAN * 2 + "heute", None, None), _row(9, LONG, "en", None),
            _row(10, "é中\U0001f600 café   x\u0000y", "fr", ""), _row(11, "ONE two THREE four", "en", "b"),
            _row(11, "ONE two THREE four", "en", "b"), _row(None, "no id here at all", "en", "a"),
            _row(13, "123 456 !!!", "en", "a")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def some_docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def some_labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")

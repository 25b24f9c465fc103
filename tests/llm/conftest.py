import pytest
from pyspark.sql import types as T

TEXTS = {"doc_id": T.LongType(), "text": T.StringType()}


@pytest.fixture
def docs(spark):
    """Rows of (doc_id, text), with a column whose name operators use themselves."""

    def make(rows):
        schema = T.StructType([
            T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType()),
            T.StructField("spans", T.StringType()), T.StructField("token_ids", T.StringType())])
        return spark.createDataFrame([(*row, "x", "y", "z") for row in rows], schema)

    return make


ODD = [(None, "no id"), (1, None), (2, ""), (3, " \n\t "), (4, "word"), (4, "word"), (5, "é€😀 ñ" * 3), (6, "a" * 70_000), (7, "12 ... !!")]


@pytest.fixture
def odd(docs):
    return docs(ODD)


@pytest.fixture
def nothing(docs):
    return docs([])

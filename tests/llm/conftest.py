import pytest
from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet " * 40_000

#: Nulls, empty, blank, very long, repeated and tied rows; ids in no order.
EDGE_TEXTS = [(7, None), (3, ""), (9, " \n\t "), (5, LONG), (4, "one two three four five six"), (2, "one two three four five six"), (4, "one two three four five six"), (8, "éü ß 你好")]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with columns beside id and text whose names the operators use themselves."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, spans string, score int, label string, word int, n string, family string"
        full = [(i, t, "en", "s", None if t is None else len(t), "x", 1, "l", 2, "n", "f") for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    return make_docs(EDGE_TEXTS)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def vector_schema():
    return T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("cell", T.StringType())])

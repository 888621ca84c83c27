import pytest
from pyspark.sql import types as T

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, label int, fp long, c0 string"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text, lang, source) rows, with clashing extra columns."""
    def make(rows):
        full = [(d, t, lang, src, None if t is None else len(t), 7, "k", 1, 3, "x") for d, t, lang, src in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)
    return make


@pytest.fixture
def vectors_of(spark):
    """Vectors from (vec_id, embedding, label) rows, with clashing extra columns."""
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                           T.StructField("label", T.IntegerType()), T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType())])

    def make(rows):
        return spark.createDataFrame([(i, v, lab, "clash", 5) for i, v, lab in rows], schema)
    return make

import pytest
from pyspark.sql import types as T


@pytest.fixture
def docs(spark):
    """Rows with nulls, empty and blank texts, ties, repeated rows, a long text and clashing columns."""
    base = " ".join(f"word{i} alpha{i % 7}" for i in range(60))
    rows = [(1, base, "en", "a", 0), (2, base, "en", "a", 0), (2, base, "en", "a", 0), (3, None, None, None, 0), (4, "", "en", "b", 0),
            (5, " \n\t ", "de", "b", 0), (6, base + " tail", "en", "c", 0), (7, "kurz und gut ist das", "de", "c", 0), (None, "no id here at all", "en", None, 0),
            (8, "Ärger über Größe " * 9000, "de", "c", 0), (9, base.replace("word5 ", "wird5 "), "en", "a", 0), (10, "12 34 !!", None, "b", 0)]
    kinds = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("size", T.IntegerType())]
    return spark.createDataFrame(rows, T.StructType([T.StructField(n, t) for n, t in kinds]))


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 0), (2, 1), (3, None), (None, 1)], "doc_id bigint, toxic int")


@pytest.fixture
def bench(spark):
    return spark.createDataFrame([(1, "word3 alpha3 word4 alpha4 word5 alpha5 word6 alpha6 word7 alpha0 word8"), (2, "Kurz UND gut"), (3, None), (4, ""), (None, "no id here")],
                                 "item_id bigint, text string")

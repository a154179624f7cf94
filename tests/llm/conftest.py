import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text) pairs."""
    from stayrate.llm.common import ship_package

    ship_package(spark)

    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENT).repartition(3)

    return make


#: Nulls, emptiness, ties, repeated rows.
ODD_ROWS = [(1, None), (2, ""), (3, " \n "), (4, "word"), (None, "no id here at all my friend"), (5, "same row twice over and over"), (5, "same row twice over and over"), (6, "é 😀 ß")]


@pytest.fixture(scope="session")
def odd_rows():
    return ODD_ROWS

import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType()), T.StructField("digest", T.StringType()), T.StructField("key", T.LongType()), T.StructField("size", T.LongType())])


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows, with extra columns whose names clash with inner ones."""
    def make(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else f"src{i % 3}", None, "x", 1, 2) for i, r in enumerate(rows)]
        return spark.createDataFrame(full, DOC).repartition(partitions)
    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and blank texts, repeated rows, a very long text and a hot text."""
    long = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))
    return [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two"), (6, "One TWO"), (7, long), (8, long), (8, long), (None, "lost its id"), (None, "lost its id"), (None, None),
            *((k, "the same hot text of several words " * 4) for k in range(100, 160))]

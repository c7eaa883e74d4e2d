import pytest
from pyspark.sql import types as T

#: Extra columns whose names clash with the operators' own.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("digest", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("component_id", T.LongType()),
        T.StructField("topic", T.StringType()),
        T.StructField("ids", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("h", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    """The folder that a cluster names in spark.checkpoint.dir."""
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return spark


@pytest.fixture(scope="session")
def make_docs(shared):
    """A documents table from (doc_id, text) or (doc_id, text, lang, source) rows, spread over partitions."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "src0")), len(r[1] or ""), *[None] * 9) for r in rows]
        return shared.createDataFrame(full, SCHEMA).repartition(partitions)

    return make


#: Nulls in every column, empty, blank and very long texts, ties, repeated rows.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t"),
    (None, "a null id and some words"),
    (None, "a null id and some words"),
    (4, "tie of two  texts"),
    (5, "tie of  two texts"),
    (6, "repeated row with several words in it"),
    (6, "repeated row with several words in it"),
    (7, "word " * 60_000),
    (8, "x" * 200_000),
    (9, "Zürich – naïve ▁ mark ÇA \U0001f600 licence", None, None),
    (10, "unique text of the tenth row", None, "src1"),
]


@pytest.fixture(scope="session")
def odd(make_docs):
    return make_docs(ODD)


@pytest.fixture(scope="session")
def empty(make_docs, shared):
    return shared.createDataFrame([], SCHEMA)


SF = "/root/testdata/sf0.001"

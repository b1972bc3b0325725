import pytest
from pyspark.sql import types as T

from tablescope.llm.runtime import show_workers

SF = "/root/testdata/sf0.001"
LONG = "word one two three four five six. " * 4000 + "end"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    show_workers(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


#: Nulls in every column, empty and very long texts, repeated rows, and extra
#: columns with names that the operators use themselves.
EDGE_DOCS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it all day long", "en", "s", 1, "x", 1, None),
    (2, "The quick brown fox jumps over the lazy dog and runs away from it all day long", None, None, None, None, None, 2),
    (2, "The quick brown fox jumps over the lazy dog and runs away from it all day long", None, None, None, None, None, 2),
    (3, None, "en", "s", 3, "y", 3, 3),
    (4, "", "en", "s", 0, "y", 3, 3),
    (5, " \n\t ", "en", "s", 4, "y", 3, 3),
    (6, LONG, "en", "s", 5, "z", 9, 9),
    (None, "Some words without an id are here, mail a@b.co or +1 (415) 555-0133 to ask for the rest of it", "en", "s", 6, "z", 9, 9),
    (None, None, None, None, None, None, None, None),
    (8, "x" * 50_000, "en", "s", 7, "z", 9, 9),
    (9, "ünï cödé 😀 <|endoftext|> [EMAIL] \x00   text\r\nline", "en", "s", 8, "z", 9, 9),
]
EDGE_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("id", T.StringType()),
    T.StructField("kept", T.LongType()), T.StructField("__m", T.LongType())])


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(EDGE_DOCS, EDGE_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)

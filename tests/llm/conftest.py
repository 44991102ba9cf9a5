import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) pairs in several partitions, with columns that clash with inner names."""

    def make(rows):
        df = spark.createDataFrame([tuple(r) for r in rows], DOCS).repartition(3)
        return df.selectExpr("doc_id", "text", "1 as n", "'x' as block", "2 as component", "text as digest", "0 as _gone")

    return make


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty and blank texts, ties, repeats, white space of all kinds, other scripts, a long text."""
    return [
        (1, None),
        (2, ""),
        (3, "  \t\n "),
        (4, "One"),
        (5, "one two three"),
        (6, "One  TWO\nthree"),
        (6, "One  TWO\nthree"),
        (7, "a\x0bb\x0cc\rd e f g"),
        (8, "İstanbul Straße naïve 日本語 テキスト 😀 ok"),
        (9, "word " * 70_000),
        (10, "word " * 70_000),
        (None, "one two three"),
        (None, "text of a row without id"),
        (None, None),
        (11, " one two three"),
    ]

"""A corpus made ready for training: quality, exact copies, near copies, personal data, packing.

Every stage reads what the one before has kept, as a written table. All but the last return the
columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brindle.llm import exact, ngram_join, packing, pii, quality
from brindle.llm.queries import WORDS, pii_key
from brindle.llm.texts import small_batches
from brindle.session import materialize

# SQL cannot express the stages; tests compare them with plain Python.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, learnt from `labels`, takes for bad."""
    small_batches(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that of the largest id."""
    return exact.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts, that of the smallest id."""
    small_batches(spark)
    return ngram_join.keep_one_of_each(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values replaced by pseudonyms."""
    replaced = pii.pseudonymize(docs, pii_key(spark))
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.length("text").cast("long"))
    return replaced.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, see `packing.pack_documents`."""
    small_batches(spark)
    return packing.pack_documents(docs, WORDS)


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("PII", without_personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

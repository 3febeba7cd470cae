"""The documents of a training corpus, from raw texts to token ids.

Every stage takes the documents the one before kept, written as Parquet and read again.
"""

from pyspark.sql import DataFrame, SparkSession

from pageflow.llm import bpe, mixing, near_dup, pii, quality
from pageflow.llm.common import prepared, saved, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    prepared(spark)
    return quality.kept_documents(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    prepared(spark)
    return near_dup.one_of_each(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to the name of its kind."""
    prepared(spark)
    return pii.without_personal_data(docs, pii.fit(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources come more than once, none of a source's documents is left out."""
    prepared(spark)
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each time a document comes."""
    prepared(spark)
    return bpe.encode_decode(docs, bpe.default_path())


STAGES = [("quality", good), ("near duplicates", distinct), ("personal data", private), ("mixing", mixed), ("encoding", encoded)]

# Expectation maximisation, a trained random field and byte-pair merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

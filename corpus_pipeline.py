"""A training corpus from raw documents: one corpus operator per stage.

Every stage takes nulls in any column, empty texts, ties, rows that repeat and an empty table; columns
it does not read are handed on, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pointloom.llm import mixing, positional, secrets, simhash, toxicity
from pointloom.llm.common import written


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model calls toxic go. It learns from those that it judges.

    Null and empty texts score as a text without words; rows alike go or stay together. Without a
    toxic label all stay.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays.

    It is the one with the smallest id, null last. Null and empty texts are alike, so one stays; of
    rows that repeat one does.
    """
    return simhash.keep_one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which words of a benchmark item occur go.

    Null and empty texts have no words and stay; rows alike go or stay together. Without items all stay.
    """
    return positional.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with its secrets masked.

    Null and empty texts stay as they are; rows alike are masked alike. Without a finding to learn
    from only the patterns are masked.
    """
    return secrets.masked_documents(docs, secrets.fit(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the training mix takes of each document; last, so no longer a corpus.

    Null and empty texts give nothing; a null source is a source. Of rows alike one may be taken in part.
    """
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", toxic_documents),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("secret scans", secret_scans),
    ("mixing", mixture),
]

# Toxicity, trained networks and the choice among equals are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

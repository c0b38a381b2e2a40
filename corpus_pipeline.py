"""From raw documents to shards of training text, as five stages that are written and read again.

Each stage takes (spark, docs, sf_dir) and returns a table. All but the last return the columns
of ``docs``; the last adds ``shard``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockloom.llm import decontaminate, langid, mixing, sharding, simhash
from stockloom.sources.scratch import scratch_path, staging

SHARDS = 40


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; what has no letter or no clear language goes."""
    return langid.accepted(docs, langid.train(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near fingerprints (four-word shingles, four bits) the document with the smallest id."""
    return simhash.drop_near_copies(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as it is or with other names and figures."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources reads them, in the order of training."""
    return mixing.in_training_order(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard."""
    return sharding.with_shard(docs, SHARDS)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("mix", mix),
    ("shards", shards),
]

ORACLE_SQL = None  # SQL has neither the fingerprints' hash nor components


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; what a stage has staged on its way goes once its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with staging(spark):
            found = function(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
    return docs

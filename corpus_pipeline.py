"""A training-data pipeline over ``documents``: good texts, one of each group of near copies, no secrets, a mix of
sources, packed sequences.

Every stage takes (spark, docs, folder) and returns a frame that is written and read again as the next stage's ``docs``.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import jaccard_join, mixing, packing, quality, secret_scan
from llm.common import ship
from tagloom.session import ensure_checkpoint_dir

#: Weights of the sources in the order of their names, in turn.
SOURCE_WEIGHTS = (5, 2, 1)
#: The mix has this share of the words that reach it, repeats counted.
MIX_BUDGET = 1.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return jaccard_join.keep_one(docs, 5, 80, 100)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets masked; n_chars follows the text."""
    clean = secret_scan.redact(docs, secret_scan.scan(docs))
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.mixed_rows(docs, SOURCE_WEIGHTS, MIX_BUDGET)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def _sent(stage):
    """The stage with its code at the executors."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("quality_rules", _sent(quality_rules)),
    ("near_duplicates", _sent(near_duplicates)),
    ("secret_scans", _sent(secret_scans)),
    ("source_mix", _sent(source_mix)),
    ("best_fit_packing", _sent(best_fit_packing)),
]

#: Token ids and drawn samples are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the checkpoint folder and read again by the next."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

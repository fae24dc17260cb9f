"""From raw documents to token ids, in five stages.

``STAGES`` lists them in order. Each is a function of (session, documents, folder of the tables) whose
result is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loyalspan.llm import bpe, exact_dedup, mixing, simhash, toxicity
from loyalspan.session import materialise

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that score 0.5 or more go; the model is fitted on the labelled ones."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels), threshold=0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near-duplicates the one with the smallest id stays."""
    return simhash.dedup(docs, shingle=3)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents are repeated, cut or left out until each source has its share of the words."""
    return mixing.mix(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every text, with the digests of the ids and of what they decode to."""
    vocabulary = public_tokenizers.path(VOCABULARY)
    coded = bpe.round_trip(docs, vocabulary, public_tokenizers.PATTERN)
    return bpe.digests(coded).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode_texts),
]

# Training a classifier and a tokenizer's merges are not SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, folder))
    return docs

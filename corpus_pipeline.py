"""A training-data pipeline over ``documents``: from raw texts to packed sequences.

Each stage works on all that its predecessor kept. Stages hand on the columns of ``documents``;
the last gives pieces of training sequences.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewatch.llm import mixing, near_duplicates, packing, personal_data, quality_rules
from scorewatch.llm.common import ship_package, shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    ship_package(spark)
    return quality_rules.drop_low_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, by shingles of five words.

    Rows without an id stay; of rows that repeat an id and are kept, one stays.
    """
    ship_package(spark)
    return near_duplicates.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tags replace personal data; ``n_chars`` follows the text."""
    return personal_data.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Readings of documents by training position, a row for each; ``n_chars`` follows the text."""
    stream = mixing.training_stream(docs)
    return stream.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of 4096 tokens, with their token ids."""
    import public_tokenizers
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality), ("minhash_near_dedup", near_dedup), ("pii", redact),
          ("source_mixing", mixed), ("packing", packed)]

#: The perplexity model, MinHash and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

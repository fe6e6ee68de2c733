"""From raw documents to packed training windows: the corpus operators one after another.

Each stage works on all that the one before it kept. All but the last return the columns of documents; the last returns pieces.
Null texts count as empty throughout, an empty table goes through every stage, and other columns pass along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from threadmill.llm import exact_dedup, near_dedup, packing, pii, quality
from threadmill.llm.common import documents, stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality model rejects; it is fitted on a bounded sample of the labelled ones."""
    return quality.kept(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space aside."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dedup.without_near_copies(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars stays that of the original text."""
    return pii.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", keep_good), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("pii", redact), ("packing", pack)]

#: SQL has no ordinal regression, tokenizer or packing; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

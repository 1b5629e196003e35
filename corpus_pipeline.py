"""Corpus pipeline: five stages over documents, each written as Parquet and read as the next one's input.

Every stage works on all rows its predecessor kept. The stages but the last return the
columns of documents; the last returns the packed token pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataload.llm import exactdup, neardup, packing, quality, secrets
from strataload.sources.scratch import settle


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, does not reject."""
    trees = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, trees, "_quality_score").filter("_quality_score >= 0.5").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the one with the largest doc_id."""
    return exactdup.exact_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one with the smallest doc_id."""
    return neardup.near_dedup(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced by a mark; n_chars follows."""
    masked = secrets.find_secrets(docs, "_secret_spans")
    text = secrets.redacted(F.col("text"), F.col("_secret_spans"))
    masked = masked.withColumn("text", text)
    if "n_chars" in docs.columns:
        hit = F.size("_secret_spans") > 0
        masked = masked.withColumn("n_chars", F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return masked.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token piece with its sequence and place there."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack),
]

#: Trained models, random projections and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "corpus")
    return STAGES[-1][1](spark, docs, sf_dir)

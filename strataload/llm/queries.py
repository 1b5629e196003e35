"""The registered queries of the corpus operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataload.llm import (
    bpe, collisions, exactdup, filteraudit, linedup, neardup, packing, quality, secrets, sharding, substring, topk, vectorcode,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    files, blocks = topk.build_files(vectors, "embedding")
    return topk.search(files, blocks, vectors.filter("vec_id % 20 = 0"), "embedding", k=20)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality.train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality.score(docs, trees, "score").select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.line_dedup(table(spark, sf_dir, "documents"), min_lines=2, min_words=8)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_groups(table(spark, sf_dir, "documents")).withColumnRenamed("digest", "text_sha256")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = secrets.find_secrets(docs, "spans")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.BASE))
    return rows.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(secrets.BASE)],
        F.sha2(secrets.written(base).cast("binary"), 256).alias("base_sha256"), secrets.written(F.col("spans")).alias("spans"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    masks = filteraudit.document_masks(docs, labels, filteraudit.text_failures(F.col("text")))
    return filteraudit.audit(masks, "ABCDE")


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    index = collisions.build_index(vectors, "vec_id", "embedding")
    return collisions.search(index, vectors.filter("vec_id % 50 = 0"), "vec_id", "embedding", k=5)


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vectorcode.compress(table(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(vectorcode.books_sha256(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_topk, op2_packing, op3_quality, op4_near_dedup, op5_bpe, op6_line_dedup, op7_substring_dedup, op8_exact_dedup, op9_secrets, op10_sharding,
              op11_audit, op12_neighbours, op13_codes)
}


def oracle_sql() -> dict[str, str]:
    from strataload.llm import oracle

    return oracle.oracle_sql()

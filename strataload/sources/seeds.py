"""Seed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataload.schemas import DIM_TRANSACTION, ORCHESTRATION_HISTORY, SEED_HISTORY, SEED_TRANSACTIONS
from pyspark.sql import types as T


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A typed seed from a CSV file with a header; malformed values raise."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def transaction_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEED_TRANSACTIONS, DIM_TRANSACTION)


def orchestration_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEED_HISTORY, ORCHESTRATION_HISTORY)

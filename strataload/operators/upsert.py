"""Merging a batch into a table by key, and fitting it to the table's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def upsert_by_key(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows replace target rows of the same key, all others stay.

    The batch must hold a key once. It is read twice, so it should be a stored
    table: then its size is known before the join, and a small batch is broadcast
    instead of shuffling the target.
    """
    kept = target.join(batch.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(batch.select(*target.columns))


def sync_all_columns(table: DataFrame, layout: T.StructType) -> DataFrame:
    """Bring a table to a changed layout: add new columns as NULL, drop the others."""
    present = set(table.columns)
    return table.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in layout
    ])

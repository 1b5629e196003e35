"""Which rows a load reads."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.schemas import START_DATE, stamp

LATEST_LOAD = "__latest_load__"


@dataclass(frozen=True)
class LoadRange:
    """The transaction dates of one load.

    An incremental load reads the half-open range (low, high] (B1, L1). An
    initial one reads exactly the date ``high`` (B2, L2), which with the default
    sentinel finds no rows and leaves just the unknown members.
    """

    low: int = START_DATE
    high: int = START_DATE
    initial: bool = False

    def contains(self, column: Column | str = "transactiondate") -> Column:
        column = F.col(column) if isinstance(column, str) else column
        if self.initial:
            return column == F.lit(self.high)
        return (column > F.lit(self.low)) & (column <= F.lit(self.high))

    def rows(self, stg: DataFrame) -> DataFrame:
        """Rows of the range; the predicate reaches the scan, or prunes partitions of a dated table."""
        return stg.where(self.contains())


def on_load(loaddate: datetime) -> Column:
    """Rows stamped by one load."""
    return F.col("loaddate") == stamp(loaddate)


def where_scope(table: DataFrame, where: str) -> DataFrame:
    """Rows that meet an SQL condition, in which ``__latest_load__`` is the newest stamp of the table.

    The newest stamp is a scalar subquery, not a join.
    """
    if LATEST_LOAD not in where:
        return table.where(where)
    newest = table.agg(F.max("loaddate")).scalar()
    return table.withColumn(LATEST_LOAD, newest).where(where).drop(LATEST_LOAD)


def latest_load(table: DataFrame) -> DataFrame:
    """Rows of the newest load in a table."""
    return where_scope(table, f"loaddate = {LATEST_LOAD}")

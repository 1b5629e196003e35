"""Monthly aggregate and the report on it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataload.functions import month_of
from strataload.schemas import DUMMY_AGG_TABLE, MONEY_SUM, stamp, typed


def latest_month(fact: DataFrame, loaddate: datetime) -> DataFrame:
    """Amount by policy in the fact's newest accounting month.

    The month is a scalar subquery over one column. Only this month is refreshed:
    late rows of older months do not change the aggregate.
    """
    newest = fact.agg(F.max("accountingdate")).scalar()
    # No date is newer, so a lower bound is enough, and unlike a month it reaches the scan.
    return month_totals(fact.where(F.col("accountingdate") >= month_of(newest) * 100), loaddate)


def month_totals(fact: DataFrame, loaddate: datetime) -> DataFrame:
    """Amount by accounting month and policy."""
    rows = (
        fact.groupBy(month_of("accountingdate").alias("month_id"), "policy_id")
        .agg(F.sum("amount").cast(MONEY_SUM).alias("metric"))
        .withColumns({"agg_id": F.col("month_id"), "loaddate": stamp(loaddate)})
    )
    return typed(rows, DUMMY_AGG_TABLE)


def refresh_latest_month(agg: DataFrame, fact: DataFrame, loaddate: datetime) -> DataFrame:
    """The aggregate after replacing its newest month (A8, A9, I14); an empty fact replaces none.

    On stored tables the same is one overwrite of the month's partition.
    """
    newest = month_of(fact.agg(F.max("accountingdate")).scalar())
    return agg.where(~F.col("month_id").eqNullSafe(newest)).unionByName(latest_month(fact, loaddate))


def report_by_state(agg: DataFrame, dim_policy: DataFrame) -> DataFrame:
    """Metric by month and state."""
    states = dim_policy.select("policy_id", F.col("policystate").alias("statecd"))
    return (
        agg.join(states, "policy_id")
        .groupBy(F.col("month_id").alias("year_month"), "statecd")
        .agg(F.sum("metric").cast(MONEY_SUM).alias("metric"))
    )

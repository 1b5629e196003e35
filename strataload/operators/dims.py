"""Plain dimensions: latest row, hashed key, allocated key."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.functions import LoadRange, surrogate_key
from strataload.operators.ids import allocate_ids, highest_id
from strataload.schemas import (
    BLANK, DIM_COVERAGE, DIM_DEDUCTIBLE, DIM_LIMIT, DIM_POLICY, MONEY, NO_CHANGE_DATE, UNKNOWN_ID,
    stamp, typed,
)


def build_scd1_latest(
    stg: DataFrame, load: LoadRange, key: str, sequence: str, attributes: dict[str, Column]
) -> DataFrame:
    """One row per key: that of the highest sequence in the range.

    Rows of the same key and sequence that disagree are settled by the smallest
    attributes in column order (L22). The best row per key combines on the map side, so a task
    sends one row per key.
    """
    rows = load.rows(stg).where(F.col(key).isNotNull() & F.col(sequence).isNotNull())
    row = F.struct((-F.col(sequence)).alias("_order"), *[value.alias(name) for name, value in attributes.items()])
    best = rows.groupBy(key).agg(F.min(row).alias("_best"))
    return best.select(key, *[F.col(f"_best.{name}").alias(name) for name in attributes])


def build_hash_dim(
    stg: DataFrame, load: LoadRange, id_col: str, columns: list[str], default: Any = BLANK
) -> DataFrame:
    """Distinct combinations of the range under a hashed key.

    The key hashes the raw values, NULL included; the stored columns are filled in.
    """
    combos = load.rows(stg).select(*columns).distinct()
    filled = [F.coalesce(F.col(c), F.lit(default)).alias(c) for c in columns]
    return combos.select(surrogate_key(*columns).alias(id_col), *filled)


def not_exists_new_members(
    dim: DataFrame, stg: DataFrame, load: LoadRange, columns: dict[str, Column]
) -> DataFrame:
    """Combinations of the range, NULLs filled in, that the dimension lacks."""
    members = load.rows(stg).select(*[value.alias(name) for name, value in columns.items()]).distinct()
    return members.join(dim.select(*columns), list(columns), "left_anti")


def build_allocated_dim(
    dim: DataFrame,
    stg: DataFrame,
    load: LoadRange,
    id_col: str,
    columns: dict[str, Column],
    default: Any,
    start: int | Column,
) -> DataFrame:
    """New members with ids following ``start``, in the order of their columns.

    An initial load leaves out only the row equal to the whole default pair (L18).
    """
    members = not_exists_new_members(dim, stg, load, columns)
    if load.initial:
        members = members.where(~reduce(and_, [F.col(c) == F.lit(default) for c in columns]))
    return allocate_ids(members, id_col, list(columns), start)


def dim_policy(stg: DataFrame, load: LoadRange, loaddate: datetime) -> DataFrame:
    """Policies of the range. A later batch always wins over an earlier one."""
    no_date = F.lit(NO_CHANGE_DATE).cast("date")
    attributes = {
        "policynumber": F.coalesce("policynumber", F.lit(BLANK)),
        "effectivedate": F.coalesce("effectivedate", no_date),
        "expirationdate": F.coalesce("expirationdate", no_date),
        "inceptiondate": F.coalesce("inceptiondate", no_date),
        "policystate": F.coalesce("policystate", F.lit(BLANK)),
        "carriercd": F.coalesce("carriercd", F.lit(BLANK)),
        "companycd": F.coalesce("companycd", F.lit(BLANK)),
    }
    rows = build_scd1_latest(stg, load, "policy_uniqueid", "transactionsequence", attributes)
    rows = rows.withColumns({"policy_id": F.col("policy_uniqueid"), "loaddate": stamp(loaddate)})
    return typed(rows, DIM_POLICY)


def dim_coverage(stg: DataFrame, load: LoadRange, loaddate: datetime) -> DataFrame:
    """Coverages of the range under a hashed key."""
    rows = build_hash_dim(stg, load, "coverage_id", ["coveragecd", "subline", "asl"])
    return typed(rows.withColumn("loaddate", stamp(loaddate)), DIM_COVERAGE)


def dim_limit(
    dim: DataFrame, stg: DataFrame, load: LoadRange, loaddate: datetime, high_water: int | Column
) -> DataFrame:
    """Limits not stored yet, numbered from a stored high-water mark."""
    columns = {c: F.coalesce(c, F.lit(BLANK)) for c in ("limit1", "limit2")}
    rows = build_allocated_dim(dim, stg, load, "limit_id", columns, BLANK, high_water)
    return typed(rows.withColumn("loaddate", stamp(loaddate)), DIM_LIMIT)


def dim_deductible(dim: DataFrame, stg: DataFrame, load: LoadRange, loaddate: datetime) -> DataFrame:
    """Deductibles not stored yet, numbered from the largest stored id (I8)."""
    zero = F.lit(UNKNOWN_ID).cast(MONEY)
    columns = {c: F.coalesce(F.col(c).cast(MONEY), zero) for c in ("deductible1", "deductible2")}
    start = highest_id(dim, "deductible_id")
    rows = build_allocated_dim(dim, stg, load, "deductible_id", columns, UNKNOWN_ID, start)
    return typed(rows.withColumn("loaddate", stamp(loaddate)), DIM_DEDUCTIBLE)

"""The transaction fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.functions import LoadRange, entity_id, surrogate_key, version_key
from strataload.operators.lookup import History, lookup, owner_lookups, start_column, with_slices
from strataload.operators.skew import SkewPolicy
from strataload.schemas import (
    DRIVER, FACT_POLICYTRANSACTION, STAMP, STG_PT, UNKNOWN_ID, UNKNOWN_KEY, VEHICLE, stamp, typed,
)

# What the fact and its lookups read; the staging table may be much wider.
FACT_INPUTS = [
    "transactiondate", "accountingdate", "transactioncd", "transactioneffectivedate", "transactionsequence",
    "policy_uniqueid", "coveragecd", "subline", "asl", "limit1", "limit2", "deductible1", "deductible2",
    "riskcd1", "riskcd2", "veh_effectivedate", "drv_effectivedate", "amount",
]
# What the hashed keys of a bare fact are made of, beside the fact's own columns.
_RISKS = ((VEHICLE, "riskcd1"), (DRIVER, "riskcd2"))
_BARE = T.StructType([
    STG_PT["policy_uniqueid"], *[STG_PT[risk] for _, risk in _RISKS],
    *[T.StructField(start_column(spec), STAMP) for spec, _ in _RISKS], T.StructField("_bare", T.BooleanType()),
])


def build_fact(
    stg: DataFrame,
    dims: dict[str, DataFrame],
    load: LoadRange,
    loaddate: datetime,
    policy: SkewPolicy = SkewPolicy(),
    largest: dict[str, int | None] | None = None,
    bare: bool = False,
) -> DataFrame:
    """One fact row per staged row of the range, with the key of every dimension.

    Facts keep the version key that held when they were loaded (L26). Dimensions that are small in
    practice add no shuffle, their joins being broadcast once measured: those that give a short id come first,
    the hashed key of a coverage is longer than its parts and comes last. Policy,
    driver and vehicle grow with the business: their keys all begin with the policy,
    so the facts are shuffled by it once for all three. ``largest`` is what the stored histories
    know of their largest policies. ``stg`` should be a stored table. A ``bare`` fact leaves out the keys that are
    hashes, a third of a row in a shuffle; ``with_hashes`` makes them where the rows arrive.
    """
    rows, slices = with_slices(load.rows(stg).select(*FACT_INPUTS), "policy_uniqueid", policy)
    rows = lookup(
        rows, dims["dim_transaction"], {"transactioncd": "transactioncd"}, "transaction_id", UNKNOWN_ID, small=True
    )
    rows = lookup(rows, dims["dim_limit"], {"limit1": "limit1", "limit2": "limit2"}, "limit_id", UNKNOWN_ID)
    rows = lookup(
        rows, dims["dim_deductible"], {"deductible1": "deductible1", "deductible2": "deductible2"},
        "deductible_id", UNKNOWN_ID,
    )
    largest = largest or {}
    rows = owner_lookups(
        rows, "policy_uniqueid", {"policy_id": (dims["dim_policy"], "policy_uniqueid", UNKNOWN_ID)},
        [
            History(dims["dim_driver"], DRIVER, entity_id("policy_uniqueid", "riskcd2"), F.col("drv_effectivedate"), largest.get("dim_driver")),
            History(dims["dim_vehicle"], VEHICLE, entity_id("policy_uniqueid", "riskcd1"), F.col("veh_effectivedate"), largest.get("dim_vehicle")),
        ],
        slices, policy, bare,
    )
    rows = lookup(
        rows, dims["dim_coverage"], {"coveragecd": "coveragecd", "subline": "subline", "asl": "asl"},
        "coverage_id", UNKNOWN_KEY,
    )
    rows = rows.withColumn("loaddate", stamp(loaddate))
    if bare:
        rows = rows.withColumns({"policytransaction_id": F.lit(None).cast("string"), "_bare": F.lit(True)})
        return typed(rows, T.StructType([*FACT_POLICYTRANSACTION.fields, *_BARE.fields]))
    return typed(rows.withColumn("policytransaction_id", surrogate_key("transactiondate")), FACT_POLICYTRANSACTION)


def with_hashes(rows: DataFrame) -> DataFrame:
    """A bare fact with its keys; rows that are not bare stay as they are."""
    made = {"policytransaction_id": F.when(F.col("_bare"), surrogate_key("transactiondate"))}
    for spec, risk in _RISKS:
        start = F.col(start_column(spec))
        made[spec.key] = F.when(start.isNotNull(), version_key(entity_id("policy_uniqueid", risk), start))
    return rows.withColumns({name: F.coalesce(key, F.col(name)) for name, key in made.items()}).drop(*_BARE.names)

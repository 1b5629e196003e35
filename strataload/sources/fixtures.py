"""The staging table made from the order tables that tests and benchmarks run on."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataload.functions import LoadRange, yyyymmdd
from strataload.schemas import MONEY, STG_PT

# Two loads that together read every row.
BATCH_1 = LoadRange(19000101, 19970101)
BATCH_2 = LoadRange(19970101, 20991231)
WHOLE = LoadRange(19000101, 20991231)

# How order priorities stand for transaction types; '5-LOW' has no type on purpose.
PRIORITY_TYPES = {
    "1-URGENT": "New Business",
    "2-HIGH": "Endorsement",
    "3-MEDIUM": "Renewal",
    "4-NOT SPECIFIED": "Cancellation",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _columns() -> dict[str, Column]:
    late = (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") > 25)
    mark = F.when(late, "x").otherwise("")
    shipped, ordered = F.col("l_shipdate"), F.col("o_orderdate")
    kind = F.col("o_orderpriority")
    for priority, name in PRIORITY_TYPES.items():
        kind = F.when(F.col("o_orderpriority") == priority, name).otherwise(kind)
    extra = F.when(late, 100).otherwise(0)
    return {
        "transactiondate": yyyymmdd(shipped),
        "accountingdate": yyyymmdd(shipped),
        "transactioncd": kind,
        "transactioneffectivedate": yyyymmdd(ordered),
        "transactionsequence": F.col("l_linenumber"),
        "policy_uniqueid": F.col("o_custkey") + 1,
        "policynumber": F.col("o_custkey").cast("string"),
        "effectivedate": ordered.cast("date"),
        "expirationdate": ordered.cast("date"),
        "inceptiondate": ordered.cast("date"),
        "policystate": F.col("o_orderstatus"),
        "carriercd": F.substring("o_orderpriority", 1, 1),
        "companycd": F.col("l_linestatus"),
        "coveragecd": F.col("p_brand"),
        "subline": F.col("p_type"),
        "asl": F.concat(F.col("p_size").cast("string"), mark),
        "limit1": F.concat(F.nullif("l_returnflag", F.lit("N")), mark),
        "limit2": F.concat(F.col("l_linestatus"), mark),
        "deductible1": (F.round(F.col("l_discount") * 100) + extra).cast(MONEY),
        "deductible2": F.round(F.col("l_tax") * 100).cast(MONEY),
        "riskcd1": (F.col("l_partkey") % 3).cast("string"),
        "riskcd2": (F.col("l_suppkey") % 2).cast("string"),
        "veh_effectivedate": ordered,
        "drv_effectivedate": ordered,
        "vin": F.col("l_returnflag"),
        "model": F.col("l_linestatus"),
        "modelyr": F.col("o_orderstatus"),
        "manufacturer": F.nullif("l_returnflag", F.lit("R")),
        "estimatedannualdistance": F.when(F.col("l_quantity") > 25, "1").otherwise("0"),
        "gendercd": F.col("l_returnflag"),
        "birthdate": F.lit(None).cast("date"),
        "maritalstatuscd": F.col("l_linestatus"),
        "pointschargedterm": F.when(F.col("l_linenumber") > 4, 1).otherwise(0),
        "amount": F.col("l_extendedprice").cast(MONEY),
    }


_NEED_PART = {"coveragecd", "subline", "asl"}
_NEED_ORDER = {
    "transactioncd", "transactioneffectivedate", "policy_uniqueid", "policynumber", "effectivedate",
    "expirationdate", "inceptiondate", "policystate", "carriercd", "veh_effectivedate", "drv_effectivedate",
    "modelyr",
}


def _shipped_within(load: LoadRange) -> Column:
    """The range on the stored time, which unlike a computed date reaches the scan."""
    def midnight(yyyymmdd_value: int, plus: int) -> Column:
        return F.lit(datetime.strptime(str(yyyymmdd_value), "%Y%m%d") + timedelta(days=plus)).cast("timestamp_ntz")

    first = midnight(load.high, 0) if load.initial else midnight(load.low, 1)
    return (F.col("l_shipdate") >= first) & (F.col("l_shipdate") < midnight(load.high, 1))


def staging(spark: SparkSession, sf_dir: str, columns: list[str] | None = None, load: LoadRange | None = None) -> DataFrame:
    """Staging rows, one per order line: the needed columns from only the needed tables, of one load if given.

    Every line has its order and its part, so leaving out a join loses no rows. Orders are joined last: the lines
    of an order, which are alike, then lie side by side in what is written.
    """
    wanted = columns or STG_PT.names
    lines = table(spark, sf_dir, "lineitem")
    made = _columns()
    # What a line alone tells is made before the joins, so that keys and quantities need not travel, unless it is
    # more than the line itself.
    own = [c for c in wanted if c not in _NEED_ORDER | _NEED_PART]
    own = own if len(own) <= len(lines.columns) else []
    lines = (lines.where(_shipped_within(load)) if load else lines).withColumns({c: made[c] for c in own})
    rows = spread(lines, "l_orderkey")
    if _NEED_PART & set(wanted):
        rows = rows.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if _NEED_ORDER & set(wanted):
        rows = rows.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(*[F.col(c) if c in own else made[c].alias(c) for c in wanted])


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Deal the rows of a table with fewer splits than cores to all cores.

    One small file is read by one task, whatever follows. A table of a cluster's
    size has far more splits than cores and is returned as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores, key) if rows._jdf.rdd().getNumPartitions() < cores else rows


VEHICLE_INPUTS = [
    "transactiondate", "policy_uniqueid", "riskcd1", "veh_effectivedate",
    "vin", "model", "modelyr", "manufacturer", "estimatedannualdistance",
]
DRIVER_INPUTS = [
    "transactiondate", "policy_uniqueid", "riskcd2", "drv_effectivedate",
    "gendercd", "birthdate", "maritalstatuscd", "pointschargedterm",
]
POLICY_INPUTS = [
    "transactiondate", "transactionsequence", "policy_uniqueid", "policynumber", "effectivedate",
    "expirationdate", "inceptiondate", "policystate", "carriercd", "companycd",
]

"""Table layouts, unknown members, seeds and the configured history dimensions."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(38, 2)
STAMP = T.TimestampNTZType()


def _field(name: str, kind: T.DataType, length: int | None = None) -> T.StructField:
    return T.StructField(name, kind, True, {"length": length} if length else None)


def _text(name: str, length: int) -> T.StructField:
    return _field(name, T.StringType(), length)


def _int(name: str) -> T.StructField:
    return _field(name, T.IntegerType())


def _long(name: str) -> T.StructField:
    return _field(name, T.LongType())


def _money(name: str) -> T.StructField:
    return _field(name, MONEY)


def _stamp(name: str) -> T.StructField:
    return _field(name, STAMP)


def _date(name: str) -> T.StructField:
    return _field(name, T.DateType())


STG_PT = T.StructType([
    _int("transactiondate"),
    _int("accountingdate"),
    _field("transactioncd", T.StringType()),
    _int("transactioneffectivedate"),
    _int("transactionsequence"),
    _long("policy_uniqueid"),
    _text("policynumber", 20),
    _date("effectivedate"),
    _date("expirationdate"),
    _date("inceptiondate"),
    _text("policystate", 2),
    _text("carriercd", 10),
    _text("companycd", 10),
    _field("coveragecd", T.StringType()),
    _field("subline", T.StringType()),
    _field("asl", T.StringType()),
    _text("limit1", 100),
    _text("limit2", 100),
    _money("deductible1"),
    _money("deductible2"),
    _field("riskcd1", T.StringType()),
    _field("riskcd2", T.StringType()),
    _stamp("veh_effectivedate"),
    _stamp("drv_effectivedate"),
    _text("vin", 20),
    _text("model", 100),
    _text("modelyr", 100),
    _text("manufacturer", 100),
    _text("estimatedannualdistance", 100),
    _text("gendercd", 10),
    _date("birthdate"),
    _text("maritalstatuscd", 10),
    _int("pointschargedterm"),
    _money("amount"),
])

STG_VEHICLE = T.StructType([
    _text("vehicle_id", 100),
    _stamp("transactioneffectivedate"),
    _text("vehicle_uniqueid", 100),
    _text("vin", 20),
    _text("model", 100),
    _text("modelyr", 100),
    _text("manufacturer", 100),
    _text("estimatedannualdistance", 100),
])

STG_DRIVER = T.StructType([
    _text("driver_id", 100),
    _stamp("transactioneffectivedate"),
    _text("driver_uniqueid", 100),
    _text("gendercd", 10),
    _text("birthdate", 10),
    _text("maritalstatuscd", 10),
    _text("pointscharged", 3),
])

DIM_TRANSACTION = T.StructType([_int("transaction_id"), _text("transactioncd", 50)])

DIM_POLICY = T.StructType([
    _long("policy_id"),
    _long("policy_uniqueid"),
    _text("policynumber", 20),
    _date("effectivedate"),
    _date("expirationdate"),
    _date("inceptiondate"),
    _text("policystate", 2),
    _text("carriercd", 10),
    _text("companycd", 10),
    _stamp("loaddate"),
])

DIM_COVERAGE = T.StructType([
    _field("coverage_id", T.StringType()),
    _field("coveragecd", T.StringType()),
    _field("subline", T.StringType()),
    _field("asl", T.StringType()),
    _stamp("loaddate"),
])

DIM_LIMIT = T.StructType([_long("limit_id"), _text("limit1", 100), _text("limit2", 100), _stamp("loaddate")])

DIM_DEDUCTIBLE = T.StructType([
    _long("deductible_id"), _money("deductible1"), _money("deductible2"), _stamp("loaddate"),
])

DIM_VEHICLE = T.StructType([
    _text("vehicle_id", 100),
    _stamp("valid_fromdate"),
    _stamp("valid_todate"),
    _text("vehicle_uniqueid", 100),
    _text("vin", 20),
    _text("model", 100),
    _text("modelyr", 100),
    _text("manufacturer", 100),
    _text("estimatedannualdistance", 100),
    _stamp("loaddate"),
])

DIM_DRIVER = T.StructType([
    _text("driver_id", 100),
    _stamp("valid_fromdate"),
    _stamp("valid_todate"),
    _text("driver_uniqueid", 100),
    _text("gendercd", 10),
    _text("birthdate", 10),
    _text("maritalstatuscd", 10),
    _text("pointscharged", 3),
    _stamp("loaddate"),
])

FACT_POLICYTRANSACTION = T.StructType([
    _text("policytransaction_id", 100),
    _int("transactiondate"),
    _int("accountingdate"),
    _int("transaction_id"),
    _int("transactioneffectivedate"),
    _int("transactionsequence"),
    _long("policy_id"),
    _stamp("veh_effectivedate"),
    _text("vehicle_id", 100),
    _text("driver_id", 100),
    _text("coverage_id", 100),
    _long("limit_id"),
    _long("deductible_id"),
    _money("amount"),
    _stamp("loaddate"),
])

DUMMY_AGG_TABLE = T.StructType([
    _int("agg_id"), _int("month_id"), _long("policy_id"), _field("metric", MONEY_SUM), _stamp("loaddate"),
])

ORCHESTRATION_LOG = T.StructType([_stamp("loaddate"), _int("transactiondate"), _stamp("endloaddate")])
OPERATION_LOG = T.StructType([_stamp("startdate"), _text("operation", 100), _stamp("enddate")])
ORCHESTRATION_HISTORY = T.StructType([_int("transactiondate")])

TABLES: dict[str, T.StructType] = {
    "dim_transaction": DIM_TRANSACTION,
    "dim_policy": DIM_POLICY,
    "dim_coverage": DIM_COVERAGE,
    "dim_limit": DIM_LIMIT,
    "dim_deductible": DIM_DEDUCTIBLE,
    "dim_vehicle": DIM_VEHICLE,
    "dim_driver": DIM_DRIVER,
    "fact_policytransaction": FACT_POLICYTRANSACTION,
    "dummy_agg_table": DUMMY_AGG_TABLE,
    "orchestration_log": ORCHESTRATION_LOG,
    "dbt_log": OPERATION_LOG,
    "orchestration_history": ORCHESTRATION_HISTORY,
}

# ---------------------------------------------------------------------------
# These must be exactly so for results to match.
# ---------------------------------------------------------------------------
UNKNOWN_KEY = "Unknown"
UNKNOWN_ID = 0
BLANK = "~"
NO_CHANGE_DATE = "1900-01-01"
START_DATE = 19000101
OPEN_END = datetime(3000, 12, 31)
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
NO_PREDECESSOR = "not_found"

SEED_TRANSACTIONS = [
    (0, "Unknown"),
    (1, "Unapply"),
    (2, "Non-Renewal Rescind"),
    (3, "Reinstatement"),
    (4, "Renewal"),
    (5, "New Business"),
    (6, "Cancellation"),
    (7, "Endorsement"),
    (8, "Non-Renewal"),
    (9, "Commission Reversal"),
]
SEED_HISTORY = [(19000102,), (20200105,), (20200115,), (20200131,), (20200215,)]

UNKNOWN_MEMBERS: dict[str, tuple] = {
    "dim_coverage": ("Unknown", "~", "~", "~"),
    "dim_deductible": (0, Decimal("0.00"), Decimal("0.00")),
    "dim_driver": ("Unknown", datetime(1900, 1, 1), datetime(3000, 1, 1), "Unknown", "~", "1900-01-01", "~", "0"),
    "dim_limit": (0, "~", "~"),
    "dim_policy": (0, 0, "Unknown", date(1900, 1, 1), date(2900, 1, 1), date(1900, 1, 1), "~", "~", "~"),
    "dim_vehicle": ("Unknown", datetime(1900, 1, 1), datetime(3000, 12, 31), "Unknown", "~", "~", "~", "~", "0"),
}
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Scd2Spec:
    """Names of one history dimension.

    ``key`` must follow from (``entity``, ``change``), as the hashed version key
    does; ``load_scd2`` relies on it to spot versions that are already stored.
    ``hashed`` says that it is just that key, made by ``version_key``, but for members such as the
    unknown one: then it need not travel with a row, and a stored version meets its staged twin in time order.
    """

    key: str
    entity: str
    change: str
    tracked: tuple[str, ...]
    hashed: bool = False

    def owner(self) -> Column:
        """The policy that an entity belongs to: its id begins with that number. NULL for the unknown member."""
        return F.substring_index(self.entity, "_", 1).try_cast("long")


VEHICLE = Scd2Spec(
    key="vehicle_id",
    entity="vehicle_uniqueid",
    change="transactioneffectivedate",
    tracked=("vin", "model", "modelyr", "manufacturer", "estimatedannualdistance"),
    hashed=True,
)
DRIVER = Scd2Spec(
    key="driver_id",
    entity="driver_uniqueid",
    change="transactioneffectivedate",
    tracked=("gendercd", "birthdate", "maritalstatuscd", "pointscharged"),
    hashed=True,
)

HISTORIES = {"dim_vehicle": VEHICLE, "dim_driver": DRIVER}


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed table with no rows."""
    return spark.createDataFrame([], schema)


def stamp(value: datetime) -> Column:
    """A load stamp as a time-zone-free literal."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast(STAMP)


def unknown_member(spark: SparkSession, table: str, loaddate: datetime) -> DataFrame:
    """The one default row of a dimension, stamped with the load."""
    return spark.createDataFrame([(*UNKNOWN_MEMBERS[table], loaddate)], TABLES[table])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a table layout: named columns, exact types, text cut to its length.

    Spark ignores the length of a varchar cast, so text is cut explicitly.
    """
    columns = []
    for field in schema:
        column = F.col(field.name).cast(field.dataType)
        length = (field.metadata or {}).get("length")
        if length:
            column = F.substring(column, 1, length)
        columns.append(column.alias(field.name))
    return df.select(*columns)

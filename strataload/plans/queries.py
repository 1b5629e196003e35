"""The registered queries: every operator over the whole of the given tables.

Text stands for times and doubles for money in the results, so that they compare
across engines; the operators themselves keep timestamps and decimals.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.functions import (
    LoadRange, entity_id, iso_date, latest_load, micros_text, month_of, packed, seconds_text, surrogate_key, yyyymmdd,
)
from strataload.operators import aggregates, checks, control, dims
from strataload.operators.facts import FACT_INPUTS, build_fact
from strataload.operators.ids import allocate_ids, highest_id
from strataload.operators.lookup import lookup, point_in_time_lookup
from strataload.operators.scd2 import (
    affected_rows, close_intervals, detect_changes, is_change, load_scd2, new_rows, open_end,
)
from strataload.operators.skew import SkewPolicy
from strataload.operators.staging import stage_driver, stage_vehicle
from strataload.operators.timeline import Timeline
from strataload.operators.upsert import sync_all_columns, upsert_by_key
from strataload.plans.cycle import LoadContext, clear_warehouse, load_dimension, run_load_cycle
from strataload.plans.parallel import side_by_side
from strataload.schemas import (
    BLANK, DRIVER, MONEY, ORCHESTRATION_HISTORY, STAMP, STG_PT, TABLES, UNKNOWN_ID, UNKNOWN_KEY,
    UNKNOWN_MEMBERS, VEHICLE, Scd2Spec, empty, stamp, unknown_member,
)
from strataload.sources import seeds
from strataload.sources.fixtures import (
    BATCH_1, BATCH_2, DRIVER_INPUTS, POLICY_INPUTS, VEHICLE_INPUTS, WHOLE, staging, table,
)
from strataload.sources.scratch import fresh_path, freed_shuffles, settle
from strataload.sources.staged_csv import export_range, load_staged, load_staged_once, read_loaded, read_staged
from strataload.sources.store import Store

Query = Callable[[SparkSession, str], DataFrame]

L0, L1, L2 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
OP_TIME = datetime(2024, 6, 1, 12)
_COVERAGE = ["coveragecd", "subline", "asl"]
EVENT = Scd2Spec(key="event_key", entity="user_key", change="at", tracked=("event_type",))

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def shown(df: DataFrame, times: Callable[[Column], Column] = seconds_text) -> DataFrame:
    """Times as text, money as double."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            column = times(column)
        elif isinstance(field.dataType, T.DateType):
            column = iso_date(column)
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def counted(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), F.sum("amount").cast("double").alias("amount"))


def once(method):
    """Keep what a method returns for as long as its object lives."""
    @wraps(method)
    def kept(self, *args):
        made = self.__dict__.setdefault("_made", {})
        key = (method.__name__, *args)
        if key not in made:
            made[key] = method(self, *args)
        return made[key]

    return kept


class State:
    """Tables as they stand after the batches, each built once and only when asked for.

    Every table that is used again is written out before, as a load would leave it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, null_mode: str = "reference"):
        self.spark, self.sf_dir, self.null_mode = spark, sf_dir, null_mode

    @once
    def stg(self, *columns: str) -> DataFrame:
        return staging(self.spark, self.sf_dir, list(columns) or None)

    @once
    def stored_stg(self) -> DataFrame:
        return settle(self.stg(*dict.fromkeys([*FACT_INPUTS, *VEHICLE_INPUTS, *DRIVER_INPUTS, *POLICY_INPUTS])), "stg")

    def _inputs(self, columns: list[str]) -> DataFrame:
        return self.stored_stg() if self.share_stg else self.stg(*columns)

    share_stg = False

    @once
    def staged_vehicle(self, load: LoadRange) -> DataFrame:
        return settle(stage_vehicle(self._inputs(VEHICLE_INPUTS), load), "stg_vehicle")

    @once
    def staged_driver(self, load: LoadRange) -> DataFrame:
        return settle(stage_driver(self._inputs(DRIVER_INPUTS), load), "stg_driver")

    @once
    def dim(self, name: str, batch: int) -> DataFrame:
        """Dimension ``name`` after ``batch`` loads, the first of which finds the unknown member."""
        if batch == 0:
            return unknown_member(self.spark, name, L0)
        before = self.dim(name, batch - 1)
        load, at = ((BATCH_1, L1), (BATCH_2, L2))[batch - 1]
        if name == "dim_vehicle":
            after = load_scd2(before, self.staged_vehicle(load), VEHICLE, at, self.null_mode)
        elif name == "dim_driver":
            after = load_scd2(before, self.staged_driver(load), DRIVER, at, self.null_mode)
        elif name == "dim_policy":
            rows = settle(dims.dim_policy(self._inputs(POLICY_INPUTS), load, at), "policies")
            after = upsert_by_key(before, rows, ["policy_id"])
        elif name == "dim_coverage":
            rows = settle(dims.dim_coverage(self._inputs(["transactiondate", *_COVERAGE]), load, at), "coverages")
            after = upsert_by_key(before, rows, ["coverage_id"])
        elif name == "dim_limit":
            stg = self._inputs(["transactiondate", "limit1", "limit2"])
            after = before.unionByName(dims.dim_limit(before, stg, load, at, highest_id(before, "limit_id")))
        else:
            stg = self._inputs(["transactiondate", "deductible1", "deductible2"])
            after = before.unionByName(dims.dim_deductible(before, stg, load, at))
        return settle(after, name)

    @once
    def all_dims(self, batch: int) -> dict[str, DataFrame]:
        """All dimensions, loaded side by side from one staging table."""
        self.share_stg = True
        self.stored_stg()
        return side_by_side(self.spark, lambda name: self.dim(name, batch), UNKNOWN_MEMBERS)

    @once
    def fact(self, batch: int) -> DataFrame:
        """Fact rows of one batch, looked up in the dimensions as that load left them; to be read once."""
        load, at = ((BATCH_1, L1), (BATCH_2, L2))[batch - 1]
        found = {**self.all_dims(batch), "dim_transaction": seeds.transaction_types(self.spark)}
        return build_fact(self.stored_stg(), found, load, at)

    @once
    def facts(self) -> DataFrame:
        """All fact rows; to be read once."""
        return self.fact(1).unionByName(self.fact(2))

    @once
    def agg(self) -> DataFrame:
        """Read from the fact more than once, so what it reads is written out."""
        one, two = (settle(self.fact(n).select("accountingdate", "policy_id", "amount"), "fact") for n in (1, 2))
        first = aggregates.latest_month(one, L1)
        return settle(aggregates.refresh_latest_month(first, one.unionByName(two), L2), "agg")


# --- load ranges and column functions ---------------------------------------


@query
def incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["transactiondate", "policy_uniqueid", "transactionsequence", "amount"]
    return shown(BATCH_2.rows(staging(spark, sf_dir, columns, BATCH_2)))


@query
def full_load_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["transactiondate", "policy_uniqueid", "transactionsequence", "amount"]
    load = LoadRange(high=19970102, initial=True)
    return shown(load.rows(staging(spark, sf_dir, columns, load)))


@query
def latest_load_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = staging(spark, sf_dir, ["transactiondate", "policy_uniqueid"])
    loaded = F.when(BATCH_1.contains(), stamp(L1)).otherwise(stamp(L2))
    return shown(latest_load(stg.withColumn("loaddate", loaded)))


@query
def surrogate_key_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = staging(spark, sf_dir, ["transactiondate", "policy_uniqueid", "limit1", "limit2"])
    return stg.select(
        "policy_uniqueid",
        surrogate_key("transactiondate").alias("date_key"),
        surrogate_key("limit1", "limit2", "policy_uniqueid").alias("limit_key"),
    )


QUERIES["surrogate_key"] = QUERIES.pop("surrogate_key_columns")


@query
def month_of_yyyymmdd(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = staging(spark, sf_dir, ["transactiondate", "amount"])
    return counted(stg.withColumn("month_id", month_of("transactiondate")), "month_id")


# --- staging views ----------------------------------------------------------


def staged_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_vehicle(staging(spark, sf_dir, VEHICLE_INPUTS), WHOLE)


QUERIES["stage_vehicle"] = lambda spark, sf_dir: shown(staged_vehicles(spark, sf_dir))
QUERIES["stage_driver"] = lambda spark, sf_dir: shown(stage_driver(staging(spark, sf_dir, DRIVER_INPUTS), WHOLE))


# --- windows and keys -------------------------------------------------------


@query
def lead_valid_to(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    line = Timeline.over(events, "user_id", ("ts", "event_id"), at_most=events.count())
    rows = line.following(line.place(events), ["ts"], "after")
    return shown(rows.select("event_id", F.coalesce("after.ts", open_end()).alias("valid_todate")), micros_text)


@query
def lag_change_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = settle(staged_vehicles(spark, sf_dir))
    line = Timeline.over(staged, VEHICLE.entity, (VEHICLE.change, VEHICLE.key), at_most=staged.count())
    rows = line.previous(line.place(staged), list(VEHICLE.tracked), "before")
    return rows.select(
        VEHICLE.key,
        is_change(VEHICLE.tracked, "before").cast("int").alias("is_change"),
        is_change(VEHICLE.tracked, "before", "null_safe").cast("int").alias("is_change_null_safe"),
    )


@query
def row_number_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = staged_vehicles(spark, sf_dir).select(VEHICLE.key, VEHICLE.entity, VEHICLE.change)
    numbered = allocate_ids(versions, "version_number", [VEHICLE.entity, VEHICLE.change])
    return numbered.select(VEHICLE.key, "version_number")


@query
def allocate_ids_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = staging(spark, sf_dir, ["transactiondate", *_COVERAGE])
    first = settle(allocate_ids(BATCH_1.rows(stg).select(*_COVERAGE).distinct(), "member_id", _COVERAGE))
    unseen = BATCH_2.rows(stg).select(*_COVERAGE).distinct().join(first, _COVERAGE, "left_anti")
    return first.unionByName(allocate_ids(unseen, "member_id", _COVERAGE, highest_id(first, "member_id")))


QUERIES["allocate_ids"] = QUERIES.pop("allocate_ids_two_batches")


# --- history ----------------------------------------------------------------


@query
def scd2_new_rows_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = State(spark, sf_dir)
    rows = new_rows(state.dim("dim_vehicle", 1), state.staged_vehicle(BATCH_2), VEHICLE.key)
    return shown(rows.select(VEHICLE.key, VEHICLE.change, VEHICLE.entity))


@query
def semi_affected_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = State(spark, sf_dir)
    rows = affected_rows(state.dim("dim_vehicle", 1), state.staged_vehicle(BATCH_2), VEHICLE.entity)
    return shown(rows.select(VEHICLE.key, VEHICLE.entity, "valid_fromdate"))


@query
def not_exists_new_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = State(spark, sf_dir)
    columns = {c: F.coalesce(c, F.lit(BLANK)) for c in _COVERAGE}
    stg = state.stg("transactiondate", *_COVERAGE)
    return dims.not_exists_new_members(state.dim("dim_coverage", 1), stg, BATCH_2, columns)


@query
def scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = State(spark, sf_dir)
    return shown(detect_changes(state.dim("dim_vehicle", 1), state.staged_vehicle(BATCH_2), VEHICLE, L2))


@query
def scd2_close_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = State(spark, sf_dir)
    never_closed = state.dim("dim_vehicle", 1).withColumn("valid_todate", open_end())
    closed = close_intervals(never_closed, state.staged_vehicle(BATCH_2), VEHICLE)
    return shown(closed.select(VEHICLE.key, "valid_fromdate", "valid_todate"))


QUERIES["scd2_initial"] = lambda spark, sf_dir: shown(State(spark, sf_dir).dim("dim_vehicle", 1))
QUERIES["scd2_initial_driver"] = lambda spark, sf_dir: shown(State(spark, sf_dir).dim("dim_driver", 1))
QUERIES["scd2_incremental"] = lambda spark, sf_dir: shown(State(spark, sf_dir).dim("dim_vehicle", 2))
QUERIES["scd2_incremental_driver"] = lambda spark, sf_dir: shown(State(spark, sf_dir).dim("dim_driver", 2))
QUERIES["scd2_incremental_null_safe"] = lambda spark, sf_dir: shown(
    State(spark, sf_dir, "null_safe").dim("dim_vehicle", 2)
)


@query
def scd2_backdated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newer half of the events first, then the older half."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_key"), F.col("user_id").cast("string").alias("user_key"),
        F.col("ts").alias("at"), "event_type",
    )
    middle = F.lit("2024-01-16").cast(STAMP)
    layout = T.StructType([
        T.StructField("event_key", T.StringType()), T.StructField("valid_fromdate", STAMP),
        T.StructField("valid_todate", STAMP), T.StructField("user_key", T.StringType()),
        T.StructField("event_type", T.StringType()), T.StructField("loaddate", STAMP),
    ])
    first = settle(load_scd2(empty(spark, layout), events.where(F.col("at") >= middle), EVENT, L1))
    rows = load_scd2(first, events.where(F.col("at") < middle), EVENT, L2)
    return shown(rows.withColumn("loaddate", seconds_text(F.col("loaddate"))), micros_text)


# Event types as entities, each with a third or so of all rows, cut into pieces of few rows.
HOT_EVENT = Scd2Spec(key="event_key", entity="kind", change="at", tracked=("user_key",))
HOT_POLICY = SkewPolicy(rows_per_group=150, versions_per_probe=64)


def hot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newer half of the events first, then the older half, by event type."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_key"), F.col("event_type").alias("kind"),
        F.col("ts").alias("at"), F.col("user_id").cast("string").alias("user_key"),
    )
    events, middle = settle(events, "events"), F.lit("2024-01-16").cast(STAMP)
    layout = T.StructType([
        T.StructField("event_key", T.StringType()), T.StructField("valid_fromdate", STAMP),
        T.StructField("valid_todate", STAMP), T.StructField("kind", T.StringType()),
        T.StructField("user_key", T.StringType()), T.StructField("loaddate", STAMP),
    ])
    newer, older = events.where(F.col("at") >= middle), events.where(F.col("at") < middle)
    first = settle(load_scd2(empty(spark, layout), newer, HOT_EVENT, L1, policy=HOT_POLICY), "history")
    return load_scd2(first, older, HOT_EVENT, L2, policy=HOT_POLICY)


@query
def scd2_incremental_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of five entities that are all hot, so both loads take the segmented scan."""
    rows = hot_history(spark, sf_dir)
    return shown(rows.withColumn("loaddate", seconds_text(F.col("loaddate"))), micros_text)


@query
def point_in_time_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by the version of their type that was in force, over hot entities of very many versions."""
    facts = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    history = settle(hot_history(spark, sf_dir), "history")
    rows = point_in_time_lookup(facts, history, HOT_EVENT, F.col("event_type"), F.col("ts"), policy=HOT_POLICY)
    return rows.groupBy("event_key").agg(F.count("*").alias("n_rows"), F.sum("event_id").alias("sum_event_ids"))


MOVEMENTS = T.StructType([STG_PT[c] for c in ("transactiondate", "accountingdate", "policy_uniqueid", "amount")] + [T.StructField("loaddate", STAMP)])


HISTORY_INPUTS = {
    "dim_vehicle": VEHICLE_INPUTS,
    "dim_coverage": ["transactiondate", *_COVERAGE],
    "movements": [c for c in MOVEMENTS.names if c != "loaddate"],
}


def history_store(spark: SparkSession, sf_dir: str, *names: str) -> Store:
    """A store after both batches of the named tables, vehicles, coverages or a dated one, each loaded as a cycle loads it.

    Each batch of a table reads its own lines, and those only with the tables and columns that it needs.
    """
    store = Store(spark, fresh_path(spark, "store"), grain="month", dated={"movements": ("loaddate", "accountingdate")})

    def load_both(name: str) -> None:
        if name != "movements":
            store.write_small(name, unknown_member(spark, name, L0))
        for load, at in ((BATCH_1, L1), (BATCH_2, L2)):
            stg = staging(spark, sf_dir, HISTORY_INPUTS[name], load)
            if name == "movements":
                store.replace_range(name, load.rows(stg).withColumn("loaddate", stamp(at)), load, at)
            else:
                load_dimension(store, name, stg, load, LoadContext(at, at))

    side_by_side(spark, load_both, names)
    return store


@query
def scd2_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches of vehicles stored in buckets, of which a load rewrites those that it touches."""
    return shown(history_store(spark, sf_dir, "dim_vehicle").read("dim_vehicle"))


@query
def zone_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pointer of a dated table knows of each month."""
    store = history_store(spark, sf_dir, "movements")
    names = ["part", "n_rows", "n_newest", "min_loaddate", "max_loaddate", "min_accountingdate", "max_accountingdate"]
    return shown(store.read("movements.parts").select(*names))


@query
def zone_latest_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amount by policy in the newest accounting month, from the parts that can hold it."""
    store = history_store(spark, sf_dir, "movements")
    month = store.newest("movements", "accountingdate") // 100 * 100
    rows = store.read_zone("movements", "accountingdate", month, layout=MOVEMENTS)
    return counted(rows, "policy_uniqueid")


@query
def observed_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load summary of three tables from what was counted while they were written."""
    store = history_store(spark, sf_dir, *HISTORY_INPUTS)
    seen = {
        "dim_coverage": store.metrics["dim_coverage"], "dim_vehicle": store.load_figures("dim_vehicle", L2),
        "movements": store.load_figures("movements", L2),
    }
    figures = {name: (m.n_on_load, m.n_rows, m.newest_load) for name, m in seen.items()}
    return shown(control.load_summary(figures, spark, L2))


# --- dimensions -------------------------------------------------------------

for _name in ("dim_policy", "dim_coverage", "dim_deductible", "dim_limit"):
    QUERIES[_name] = lambda spark, sf_dir, name=_name: shown(State(spark, sf_dir).dim(name, 2))


@query
def seed_transaction_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seeded type with its staged rows; rows of no type count as Unknown."""
    types = seeds.transaction_types(spark)
    per_code = staging(spark, sf_dir, ["transactioncd", "amount"]).groupBy("transactioncd").agg(
        F.count("*").alias("n_rows"), F.sum("amount").alias("amount")
    )
    typed_rows = lookup(per_code, types, {"transactioncd": "transactioncd"}, "transaction_id", UNKNOWN_ID, small=True)
    totals = typed_rows.groupBy("transaction_id").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("amount").cast("double").alias("amount")
    )
    return types.join(totals, "transaction_id", "left").fillna({"n_rows": 0, "amount": 0.0})


@query
def unknown_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unknown member of each dimension with the facts that fell to it."""
    fact = State(spark, sf_dir).facts()
    names = sorted(UNKNOWN_MEMBERS)
    keys = {name: f"{name.removeprefix('dim_')}_id" for name in names}
    unknown = {
        name: F.lit(UNKNOWN_KEY if dict(fact.dtypes)[key] == "string" else UNKNOWN_ID) for name, key in keys.items()
    }
    counts = fact.agg(*[F.count_if(F.col(keys[n]) == unknown[n]).alias(n) for n in names])
    pairs = F.array(*[F.struct(F.lit(n).alias("dim"), F.col(n).alias("n_facts")) for n in names])

    def member(name: str) -> DataFrame:
        row = unknown_member(spark, name, L0)
        parts = [seconds_text(F.col(c)) if isinstance(row.schema[c].dataType, T.TimestampNTZType)
                 else F.col(c).cast("string") for c in row.columns if c != "loaddate"]
        return row.select(F.lit(name).alias("dim"), F.concat_ws("|", *parts).alias("member"))

    members = reduce(DataFrame.unionByName, [member(n) for n in names])
    return counts.select(F.inline(pairs)).join(members, "dim").select("dim", "member", "n_facts")


# --- lookups and fact -------------------------------------------------------


@query
def lookup_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = State(spark, sf_dir)
    rows = state.stg("transactioncd", "policy_uniqueid", "amount")
    rows = lookup(rows, seeds.transaction_types(spark), {"transactioncd": "transactioncd"}, "transaction_id",
                  UNKNOWN_ID, small=True)
    rows = lookup(rows, state.dim("dim_policy", 2), {"policy_uniqueid": "policy_uniqueid"}, "policy_id", UNKNOWN_ID)
    return counted(rows, "transaction_id", "policy_id")


@query
def lookup_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = State(spark, sf_dir)
    rows = state.stg(*_COVERAGE, "limit1", "limit2", "amount")
    rows = lookup(rows, state.dim("dim_coverage", 2), {c: c for c in _COVERAGE}, "coverage_id", UNKNOWN_KEY)
    rows = lookup(rows, state.dim("dim_limit", 2), {c: c for c in ("limit1", "limit2")}, "limit_id", UNKNOWN_ID)
    return counted(rows, "coverage_id", "limit_id")


def _amount_by_version(spark: SparkSession, sf_dir: str, batch: int, policy: SkewPolicy) -> DataFrame:
    state = State(spark, sf_dir)
    stg = state.stg("policy_uniqueid", "riskcd1", "veh_effectivedate", "amount")
    rows = point_in_time_lookup(
        stg, state.dim("dim_vehicle", batch), VEHICLE, entity_id("policy_uniqueid", "riskcd1"),
        F.col("veh_effectivedate"), policy=policy,
    )
    return counted(rows, VEHICLE.key)


@query
def point_in_time_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amount per vehicle version in force, over a history loaded out of order."""
    return _amount_by_version(spark, sf_dir, 2, SkewPolicy())


@query
def point_in_time_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup by the way taken for entities with very many versions."""
    return _amount_by_version(spark, sf_dir, 2, SkewPolicy(versions_per_probe=0))


QUERIES["fact_build"] = lambda spark, sf_dir: shown(State(spark, sf_dir).facts())


@query
def reconcile_staging_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = State(spark, sf_dir)
    return shown(checks.staging_and_fact_totals(state.stg("transactiondate", "amount"), state.fact(2), BATCH_2, L2))


@query
def fact_reload_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches stored, the second one twice; the first and second share a month."""
    store = Store(spark, fresh_path(spark, "reload"), grain="month", dated={"reload": ()})
    stg = staging(spark, sf_dir, ["transactiondate", "amount", "transactionsequence"])
    for load in (BATCH_1, BATCH_2, BATCH_2):
        store.replace_range("reload", load.rows(stg), load)
    return counted(store.read_parts("reload", layout=stg.schema), "transactiondate")


QUERIES["agg_latest_month"] = lambda spark, sf_dir: shown(State(spark, sf_dir).agg())


@query
def report_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = State(spark, sf_dir)
    return shown(aggregates.report_by_state(state.agg(), state.dim("dim_policy", 2)))


# --- merging ----------------------------------------------------------------


@query
def upsert_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal", stamp(L1).alias("loaddate")
    )
    orders = table(spark, sf_dir, "orders")
    seen = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.lit("seen").alias("c_name"), F.max("o_totalprice").alias("c_acctbal"), stamp(L2).alias("loaddate")
    )
    fresh = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_acctbal").alias("c_acctbal"), stamp(L2).alias("loaddate"),
    )
    return shown(upsert_by_key(target, seen.unionByName(fresh), ["c_custkey"]))


QUERIES["upsert_by_key"] = QUERIES.pop("upsert_customers")


@query
def sync_customer_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
        T.StructField("c_segment", T.StringType()), T.StructField("c_acctbal", MONEY),
    ])
    return shown(sync_all_columns(table(spark, sf_dir, "customer"), layout))


QUERIES["sync_all_columns"] = QUERIES.pop("sync_customer_columns")


# --- load control -----------------------------------------------------------


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load per shipping month, those since October 2001 still open."""
    shipped = F.max("l_shipdate")
    months = table(spark, sf_dir, "lineitem").groupBy(month_of(yyyymmdd(F.col("l_shipdate")))).agg(shipped.alias("last"))
    after = F.col("last") + F.expr("INTERVAL 24 HOURS")
    is_closed = F.col("last") < F.lit("2001-10-01").cast(STAMP)
    return months.select(
        (F.col("last") + F.expr("INTERVAL 23 HOURS")).cast(STAMP).alias("loaddate"),
        yyyymmdd(F.col("last")).alias("transactiondate"),
        F.when(is_closed, after).cast(STAMP).alias("endloaddate"),
    )


def operation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One operation per event, those of small value still open."""
    started = seconds_text(F.col("ts")).cast(STAMP)
    ended = F.when(F.col("value") >= 5, started + F.expr("INTERVAL 1 MINUTE"))
    return table(spark, sf_dir, "events").select(
        started.alias("startdate"), F.col("event_type").alias("operation"), ended.cast(STAMP).alias("enddate")
    )


QUERIES["latest_loaded_date"] = lambda spark, sf_dir: control.latest_loaded_date(load_log(spark, sf_dir))


@query
def next_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = staging(spark, sf_dir, ["transactiondate"])
    return control.next_cutoff(history, control.latest_loaded_date(load_log(spark, sf_dir)).scalar())


QUERIES["orchestration_open"] = lambda spark, sf_dir: shown(
    control.orchestration_open(load_log(spark, sf_dir), L1, 20991231)
)


@query
def orchestration_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = settle(load_log(spark, sf_dir), "loads")
    return shown(control.orchestration_close(log, log.agg(F.max("loaddate")).first()[0], L2))


QUERIES["oplog_open"] = lambda spark, sf_dir: shown(
    control.oplog_open(operation_log(spark, sf_dir), ["load_scd2: dim_vehicle"], OP_TIME)
)
@query
def oplog_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A start event of every operation and an end event of those that ended, folded to one row each."""
    log = operation_log(spark, sf_dir)
    started = log.withColumn("enddate", F.lit(None).cast(STAMP))
    return shown(control.fold_operations(started.unionByName(log.where("enddate IS NOT NULL"))))


QUERIES["oplog_close"] = lambda spark, sf_dir: shown(
    control.oplog_close(operation_log(spark, sf_dir), ["click"], OP_TIME)
)


@query
def daily_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = State(spark, sf_dir)
    facts = state.facts()
    tables = dict(sorted(state.all_dims(2).items()))
    return shown(control.daily_load_summary({**tables, "fact_policytransaction": facts}, L2))


# --- checks, over tables that do hold violations ----------------------------

QUERIES["test_unique"] = lambda spark, sf_dir: checks.unique(table(spark, sf_dir, "lineitem"), "l_orderkey")
QUERIES["test_unique_combination"] = lambda spark, sf_dir: checks.unique_combination(
    table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
)


@query
def test_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = staging(spark, sf_dir, ["transactiondate", "limit1", "limit2", "amount"])
    return shown(checks.not_null(stg, "limit1").drop("limit1"))


@query
def test_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = State(spark, sf_dir)
    child = state.stg("policy_uniqueid", "riskcd1").select(
        entity_id("policy_uniqueid", "riskcd1").alias("vehicle_uniqueid")
    )
    return checks.relationships(child, "vehicle_uniqueid", state.dim("dim_vehicle", 1), "vehicle_uniqueid")


@query
def test_scoped_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = staging(spark, sf_dir, ["transactiondate", "limit1", "limit2", "amount"])
    stamped = stg.withColumn("loaddate", F.when(BATCH_1.contains(), stamp(L1)).otherwise(stamp(L2)))
    check = checks.Check("stg", "not_null", ("limit1",), where=checks.NEWEST)
    return shown(check.violations({"stg": stamped}).drop("limit1", "loaddate"))


# --- files and whole loads --------------------------------------------------

_FILE_COLUMNS = ["transactiondate", "policy_uniqueid", "transactioncd", "limit1", "amount"]
_FILE_LAYOUT = T.StructType([STG_PT[c] for c in _FILE_COLUMNS])


@query
def export_range_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "export")
    export_range(staging(spark, sf_dir, _FILE_COLUMNS), BATCH_2, path)
    return shown(read_staged(spark, path, _FILE_LAYOUT))


@query
def stage_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches exported and appended to one staging table."""
    staged = fresh_path(spark, "stg_pt")
    source = staging(spark, sf_dir, _FILE_COLUMNS)
    for load in (BATCH_1, BATCH_2):
        path = fresh_path(spark, "export")
        export_range(source, load, path)
        load_staged(spark, path, _FILE_LAYOUT, staged)
    return shown(spark.read.schema(_FILE_LAYOUT).parquet(staged).select(*_FILE_COLUMNS))


@query
def stage_csv_load_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches exported, everything staged after each, and a third time with nothing new."""
    root = fresh_path(spark, "staging")
    source = staging(spark, sf_dir, _FILE_COLUMNS)
    for load in (BATCH_1, BATCH_2, None):
        if load:
            export_range(source, load, f"{root}/export/{load.low}-{load.high}")
        load_staged_once(spark, f"{root}/export/*", _FILE_LAYOUT, f"{root}/stg_pt")
    return shown(read_loaded(spark, _FILE_LAYOUT, f"{root}/stg_pt"))


@query
def seed_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seed file made of the nations, read with its types, with the customers of each."""
    path = fresh_path(spark, "seed")
    table(spark, sf_dir, "nation").select("n_nationkey", "n_name").coalesce(1).write.option("header", True).csv(path)
    seed = seeds.read_seed(spark, path, T.StructType([T.StructField("n_nationkey", T.LongType()), T.StructField("n_name", T.StringType())]))
    per_nation = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n_customers"))
    return seed.join(per_nation, "n_nationkey", "left").fillna({"n_customers": 0})


@query
def full_refresh_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loaded dimension rebuilt: the unknown member and the rows of exactly one date."""
    store = Store(spark, fresh_path(spark, "refresh"))
    stg = staging(spark, sf_dir, ["transactiondate", *_COVERAGE])
    store.write("dim_coverage", dims.dim_coverage(stg, BATCH_1, L1))
    one_date = dims.dim_coverage(stg, LoadRange(high=19970102, initial=True), L2)
    return shown(store.write("dim_coverage", unknown_member(spark, "dim_coverage", L0).unionByName(one_date)))


@query
def load_cycle_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty warehouse, then two loads end to end; totals of the fact by load."""
    store = Store(spark, fresh_path(spark, "warehouse"), grain="month")
    cutoffs = spark.createDataFrame([(BATCH_1.high,), (BATCH_2.high,)], ORCHESTRATION_HISTORY)
    clear_warehouse(store, LoadContext(L0, L0), cutoffs)
    with freed_shuffles(spark):
        source = settle(staging(spark, sf_dir), "source")
    for at in (L1, L2):
        result = run_load_cycle(store, source, LoadContext(at, at.replace(hour=1)))
        if result.failed_checks or not result.reconciled:
            raise RuntimeError(f"load {at} failed its checks: {result.failed_checks}")
    totals = store.read_partitioned("fact_policytransaction").groupBy("loaddate").agg(
        F.count("*").alias("n_rows"),
        F.sum("amount").alias("amount"),
        F.count_distinct("policy_id").alias("n_policies"),
        F.count_distinct(packed(F.col("vehicle_id"))).alias("n_vehicle_versions"),
        F.count_distinct(packed(F.col("driver_id"))).alias("n_driver_versions"),
        F.count_if(F.col("limit_id") == UNKNOWN_ID).alias("n_unknown_limits"),
        F.sum("deductible_id").alias("sum_deductible_ids"),
        F.sum("limit_id").alias("sum_limit_ids"),
    )
    return shown(totals)

"""One load from cutoff to checks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataload.functions import LoadRange
from strataload.operators import aggregates, checks, control, dims
from strataload.operators.facts import build_fact, with_hashes
from strataload.operators.ids import highest_id
from strataload.operators.scd2 import load_scd2
from strataload.operators.skew import SkewPolicy
from strataload.operators.staging import stage_driver, stage_vehicle
from strataload.operators.upsert import upsert_by_key
from strataload.plans.parallel import side_by_side
from strataload.schemas import HISTORIES, STG_PT, TABLES, UNKNOWN_MEMBERS, empty, unknown_member
from strataload.sources import seeds
from strataload.sources.scratch import discard, freed_shuffles, remove, scope, settle
from strataload.sources.staged_csv import export_range, load_staged_once, read_loaded
from strataload.sources.store import Store

FACT, AGG = "fact_policytransaction", "dummy_agg_table"
DIMS = tuple(sorted(UNKNOWN_MEMBERS))
STAGES = frozenset({"extract", "stage", "dims", "facts", "aggregates", "tests"})
# Sequence positions of tables whose ids come from a sequence; never below the ids in use.
SEQUENCES = "key_high_water"
STAGED, EXPORTS, EVENTS = "stg_pt", "export", "dbt_log.events"
# Rows of an exported file, about 100 MB of text, that one task unpacks.
EXPORT_ROWS = 500_000


@dataclass(frozen=True)
class LoadContext:
    """Stamps of one load, passed in so that a run can be repeated exactly.

    Operations start at the load's stamp and end at its end stamp, or each at its own time if a ``clock`` is given.
    """

    loaddate: datetime
    endloaddate: datetime
    clock: Callable[[], datetime] | None = None

    def started(self) -> datetime:
        return self.clock() if self.clock else self.loaddate

    def ended(self) -> datetime:
        return self.clock() if self.clock else self.endloaddate


@dataclass
class LoadResult:
    load: LoadRange | None = None
    summary: DataFrame | None = None
    failed_checks: dict[str, int] = field(default_factory=dict)
    reconciled: bool | None = None
    staged_rows: int | None = None


def clear_warehouse(
    store: Store,
    ctx: LoadContext,
    history: DataFrame | None = None,
    load_defaults: bool = True,
    transaction_types: DataFrame | None = None,
    seed_folder: str | None = None,
) -> None:
    """Rebuild every table empty, with unknown members if wanted, and load the seeds.

    ``seed_folder`` holds the seeds as ``dim_transaction.csv`` and ``orchestration_history.csv`` (A5); a frame
    passed in goes before it, and the built-in seeds come last. Exported and staged files go too.
    """
    spark = store.spark

    def seed(name: str, given: DataFrame | None, built_in: Callable[[SparkSession], DataFrame]) -> DataFrame:
        if given is not None:
            return given
        return seeds.read_seed(spark, f"{seed_folder}/{name}.csv", TABLES[name]) if seed_folder else built_in(spark)

    starting = {
        "orchestration_log": empty(spark, TABLES["orchestration_log"]),
        "dbt_log": empty(spark, TABLES["dbt_log"]),
        "dim_transaction": seed("dim_transaction", transaction_types, seeds.transaction_types),
        "orchestration_history": seed("orchestration_history", history, seeds.orchestration_history),
        SEQUENCES: spark.createDataFrame([("dim_limit", 0)], "name string, high_water long"),
    }
    for name in DIMS:
        starting[name] = unknown_member(spark, name, ctx.loaddate) if load_defaults else empty(spark, TABLES[name])
    for name in (FACT, AGG):
        store.clear(name)
    for name in (EXPORTS, STAGED, f"{STAGED}.ledger", EVENTS):
        remove(spark, store.path(name))
    side_by_side(spark, lambda name: store.write_small(name, starting[name]), starting)


def next_range(store: Store) -> LoadRange | None:
    """The range after the newest closed load, None if no cutoff is left."""
    latest = control.latest_loaded_date(store.read("orchestration_log")).first()[0]
    cutoff = control.next_cutoff(store.read("orchestration_history"), latest).first()[0]
    return None if cutoff is None else LoadRange(latest, cutoff)


def operations(store: Store) -> DataFrame:
    """The operation log: what was stored, and the events since then, one row per operation."""
    stored = store.read("dbt_log")
    if not store.has(EVENTS):
        return stored
    events = store.spark.read.schema(TABLES["dbt_log"]).parquet(f"{store.path(EVENTS)}/*")
    return control.fold_operations(stored.unionByName(events))


def _append_event(store: Store, names: Iterable[str], started: datetime, ended: datetime | None = None) -> None:
    """Each event in a folder of its own, so that operations that end side by side do not meet."""
    event = control.operation_events(store.spark, names, started, ended)
    event.coalesce(1).write.parquet(f"{store.path(EVENTS)}/{uuid.uuid4().hex}")


def _settle_events(store: Store) -> None:
    """Store the folded log and drop the events in it; dying in between only means that they are folded again."""
    if store.has(EVENTS):
        store.write_small("dbt_log", operations(store))
        remove(store.spark, store.path(EVENTS))


def _logged(store: Store, ctx: LoadContext, names: tuple[str, ...], work: Callable[[str], object]) -> None:
    """Run operations side by side; each ends in the log when it ends, and one that fails stays open alone."""
    started = ctx.started()
    _append_event(store, names, started)

    def run(name: str) -> None:
        work(name)
        _append_event(store, [name], started, ctx.ended())

    side_by_side(store.spark, run, names)


def _load_in_parts(
    store: Store, name: str, arrived: DataFrame, owner: Column, merge: Callable[[DataFrame, DataFrame], DataFrame], at: datetime
) -> None:
    """Merge a batch into the buckets of the policies it names; all other buckets stay the same files."""
    arrived = settle(arrived, name)
    touched = set(store.buckets_of(arrived, owner))
    stored = store.read_parts(name, [r for r in store.pointer(name) if r.part in touched]).select(*TABLES[name].names)
    store.replace_parts(name, merge(stored, arrived), touched.__contains__, at)
    discard(arrived)


def load_dimension(
    store: Store, name: str, stg: DataFrame, load: LoadRange, ctx: LoadContext, policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    """Load one range into one dimension and store what it changes."""
    at = ctx.loaddate
    if name == "dim_policy":
        merge = lambda stored, rows: upsert_by_key(stored, rows, ["policy_id"])
        _load_in_parts(store, name, dims.dim_policy(stg, load, at), F.col("policy_uniqueid"), merge, at)
        return store.read(name)
    if name in HISTORIES:
        spec, stage = HISTORIES[name], {"dim_vehicle": stage_vehicle, "dim_driver": stage_driver}[name]
        # The key is the hash of entity and change time, so it is not stored with the arrived rows.
        merge = lambda stored, rows: load_scd2(stored, rows, spec, at, policy=policy)
        _load_in_parts(store, name, stage(stg, load).drop(spec.key), spec.owner(), merge, at)
        return store.read(name)
    stored = store.read(name)
    if name == "dim_coverage":
        after = upsert_by_key(stored, settle(dims.dim_coverage(stg, load, at), name), ["coverage_id"])
    elif name == "dim_deductible":
        after = stored.unionByName(dims.dim_deductible(stored, stg, load, at))
    elif name == "dim_limit":
        mark = store.read(SEQUENCES).where(F.col("name") == name).select("high_water").scalar()
        high_water = F.greatest(mark, highest_id(stored, "limit_id"))
        after = stored.unionByName(dims.dim_limit(stored, stg, load, at, high_water))
    else:
        raise ValueError(f"{name} is not a loaded dimension")
    written = store.write(name, after, loaddate=at)
    if name == "dim_limit":
        used = F.greatest("high_water", highest_id(written, "limit_id"))
        mark = F.when(F.col("name") == name, used).otherwise(F.col("high_water"))
        store.write_small(SEQUENCES, store.read(SEQUENCES).withColumn("high_water", mark))
    return written


def tables(store: Store) -> dict[str, DataFrame]:
    """Every stored table by name."""
    return {**{name: store.read(name) for name in (*TABLES, FACT, AGG)}, "dbt_log": operations(store)}


def newest_loads(store: Store) -> dict[str, DataFrame]:
    """The newest load of every table in parts, read from the parts that hold it."""
    found = {name: store.newest(name) for name in (*DIMS, FACT) if store.parting(name)}
    return {name: store.read_zone(name, "loaddate", at) for name, at in found.items() if at is not None}


def summary(store: Store, loaddate: datetime) -> DataFrame:
    """The load summary from what was counted while writing; only a table not written by this load is read."""
    figures, unknown = {}, {}
    for name in (*DIMS, FACT):
        seen = store.load_figures(name, loaddate) if store.parting(name) else store.metrics.get(name)
        if seen is None:
            unknown[name] = store.read(name)
        else:
            figures[name] = (seen.n_on_load, seen.n_rows, seen.newest_load)
    rows = control.load_summary(figures, store.spark, loaddate)
    return rows.unionByName(control.daily_load_summary(unknown, loaddate)) if unknown else rows


def register_views(store: Store, stg: DataFrame | None = None, load: LoadRange | None = None) -> None:
    """Make the tables, the report and, for a given range, the staging views known to SQL.

    The range is fixed when the views are made; make them again for the next load.
    """
    found = tables(store)
    for name, table in found.items():
        table.createOrReplaceTempView(name)
    report = aggregates.report_by_state(found[AGG], found["dim_policy"])
    report.createOrReplaceTempView("dummy_view_for_reporting")
    if stg is not None and load is not None:
        stage_vehicle(stg, load).createOrReplaceTempView("stg_vehicle")
        stage_driver(stg, load).createOrReplaceTempView("stg_driver")


def run_load_cycle(
    store: Store,
    source: DataFrame,
    ctx: LoadContext,
    stages: frozenset[str] = STAGES,
    policy: SkewPolicy = SkewPolicy(),
) -> LoadResult:
    """Load the next range from ``source``; an empty result if nothing is left to load.

    The load is closed before the checks run, so a failed check does not make the
    range load again. A load that dies before that leaves its log row open and its
    range is taken up by the next run; every step of it can be repeated. ``extract`` writes the range as
    CSV files, ``stage`` loads the files that are there and not loaded yet into the staging table that stays;
    without ``stage`` the load reads ``source`` itself. What the load settles on its way is removed
    either way, the shuffle files of each step as the step ends, and at its end old versions of tables. A stage
    name that does not exist is an error before anything is done.
    """
    if unknown := sorted(stages - STAGES):
        raise ValueError(f"unknown stages {unknown}; known are {sorted(STAGES)}")
    spark, load = store.spark, next_range(store)
    if load is None:
        return LoadResult()
    result = LoadResult(load)
    with freed_shuffles(spark):
        store.metrics.clear()
        log = control.orchestration_open(store.read("orchestration_log"), ctx.loaddate, load.high)
        store.write_small("orchestration_log", log)

        with scope(spark, "load"):
            export = f"{store.path(EXPORTS)}/{load.low}-{load.high}"
            # A complete export is kept: its files are known to the ledger by name.
            if "extract" in stages and not store.has(f"{EXPORTS}/{load.low}-{load.high}/_SUCCESS"):
                export_range(source, load, export, EXPORT_ROWS)
            stg = source
            if "stage" in stages:
                result.staged_rows = load_staged_once(spark, f"{store.path(EXPORTS)}/*", STG_PT, store.path(STAGED))
                stg = read_loaded(spark, STG_PT, store.path(STAGED)) if store.has(STAGED) else empty(spark, STG_PT)
            _load_and_check(store, stg, ctx, stages, policy, result)
        _settle_events(store)
        store.tidy([*TABLES, FACT, AGG, SEQUENCES])
    return result


def _refresh_aggregate(store: Store, ctx: LoadContext) -> None:
    """Replace the fact's newest month, reading the parts that can hold it; an empty fact replaces none."""
    newest = store.newest(FACT, "accountingdate")
    if newest is None:
        return
    rows = aggregates.month_totals(store.read_zone(FACT, "accountingdate", newest // 100 * 100), ctx.loaddate)
    store.replace_parts(AGG, rows, lambda part: part == newest // 100)


def _load_and_check(
    store: Store, stg: DataFrame, ctx: LoadContext, stages: frozenset[str], policy: SkewPolicy, result: LoadResult
) -> None:
    """The stages after staging, and the closing of the load."""
    load = result.load
    if "dims" in stages:
        _logged(store, ctx, DIMS, lambda name: load_dimension(store, name, stg, load, ctx, policy))
    if "facts" in stages:
        current = {name: store.read(name) for name in (*DIMS, "dim_transaction")}
        largest = {name: max((r.largest for r in store.pointer(name)), default=0) for name in HISTORIES}
        fact = build_fact(stg, current, load, ctx.loaddate, policy, largest, bare=True)
        _logged(store, ctx, (FACT,), lambda name: store.replace_range(name, fact, load, ctx.loaddate, with_hashes))
    if "aggregates" in stages:
        _logged(store, ctx, (AGG,), lambda name: _refresh_aggregate(store, ctx))

    log = control.orchestration_close(store.read("orchestration_log"), ctx.loaddate, ctx.endloaddate)
    store.write_small("orchestration_log", log)
    result.summary = summary(store, ctx.loaddate)
    if "tests" in stages:
        result.failed_checks = checks.failures(tables(store), newest=newest_loads(store))
        result.reconciled = _reconciled(store, stg, load, ctx.loaddate)


def _reconciled(store: Store, stg: DataFrame, load: LoadRange, loaddate: datetime) -> bool:
    """Whether the fact got what staging holds; the fact's side was counted while it was written (K6)."""
    if (written := store.metrics.get(FACT)) is None:
        at_load = store.read_zone(FACT, "loaddate", loaddate, loaddate)
        return checks.reconcile(stg, at_load, load, loaddate).isEmpty()
    staged = load.rows(stg).agg(F.count("*"), F.sum("amount")).first()
    return not checks.figures_differ(tuple(staged), (written.n_on_load, written.amount))

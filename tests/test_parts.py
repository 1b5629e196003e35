"""Tables in parts: what a load rewrites, prunes, commits and counts."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strataload.functions import LoadRange
from strataload.operators import checks
from strataload.operators.lookup import History, owner_lookups, point_in_time_lookup, with_slices
from strataload.operators.scd2 import load_scd2
from strataload.operators.skew import SkewPolicy
from strataload.plans import cycle
from strataload.plans.cycle import FACT, LoadContext, clear_warehouse, load_dimension, operations, run_load_cycle
from strataload.schemas import (
    DIM_VEHICLE, DRIVER, FACT_POLICYTRANSACTION, ORCHESTRATION_HISTORY, STG_PT, STG_VEHICLE, VEHICLE, empty, unknown_member,
)
from strataload.sources.scratch import discard, scope, settle, shared_root
from strataload.sources.staged_csv import export_range, load_staged_once, read_loaded, read_staged
from strataload.sources.store import Store
from test_cycle import ROWS, source_row

T0, T1, T2 = (datetime(2024, 1, d) for d in (1, 2, 3))


def files(root: Path) -> dict[str, float]:
    return {str(p.relative_to(root)): p.stat().st_mtime for p in root.rglob("*.parquet")}


def plan_of(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_load_leaves_untouched_buckets_as_they_are(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=8)
    first = [source_row(20200103, p, "1", datetime(2020, 1, 1), "A", 1) for p in range(1, 60)]
    second = [source_row(20200110, 7, "1", datetime(2020, 2, 1), "B", 1), source_row(20200110, 7, "1", datetime(2019, 2, 1), "C", 1)]
    stg = spark.createDataFrame(first + second, STG_PT)
    for name in ("dim_vehicle", "dim_policy"):
        store.write_small(name, unknown_member(spark, name, T0))
    batches = (LoadRange(19000101, 20200105), LoadRange(20200105, 20200115))
    load_dimension(store, "dim_vehicle", stg, batches[0], LoadContext(T1, T1))
    load_dimension(store, "dim_policy", stg, batches[0], LoadContext(T1, T1))
    before = {name: (files(tmp_path / name / "data"), {r.part: r for r in store.pointer(name)}) for name in ("dim_vehicle", "dim_policy")}
    bucket = store.buckets_of(spark.range(1).select(F.lit(7).cast("long").alias("p")), F.col("p"))
    for name in before:
        load_dimension(store, name, stg, batches[1], LoadContext(T2, T2))
        old_files, old_parts = before[name]
        assert {p: t for p, t in files(tmp_path / name / "data").items() if p in old_files} == old_files
        changed = [r.part for r in store.pointer(name) if r != old_parts.get(r.part)]
        assert changed == bucket and len(store.pointer(name)) > 4
        new = set(files(tmp_path / name / "data")) - set(old_files)
        assert new and all(f"/bucket={bucket[0]}/" in p for p in new)
    versions = store.read("dim_vehicle").where("vehicle_uniqueid = '7_1'").orderBy("valid_fromdate").collect()
    assert [v.vin for v in versions] == ["C", "A", "B"] and store.read("dim_vehicle").count() == 62
    assert max(r.largest for r in store.pointer("dim_vehicle")) == 3
    # What only old pointers name is deleted; everything in force stays.
    rows = sorted(map(tuple, store.read("dim_vehicle").collect()), key=repr)
    store.tidy(["dim_vehicle"], keep=1)
    assert sorted(map(tuple, store.read("dim_vehicle").collect()), key=repr) == rows
    assert len(files(tmp_path / "dim_vehicle" / "data")) < len(before["dim_vehicle"][0]) + 2
    with pytest.raises(ValueError, match="8 buckets"):
        Store(spark, str(tmp_path), buckets=4).read("dim_vehicle")


def test_bucketed_loads_equal_loads_of_the_whole_table(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=3)
    rows = [source_row(20200103 + d, p, str(r), datetime(2020, 1 + (d * p) % 9, 1), "AB"[(d + r) % 2], 1) for d in range(4) for p in range(9) for r in range(2)]
    stg = spark.createDataFrame(rows, STG_PT)
    whole = unknown_member(spark, "dim_vehicle", T0)
    store.write_small("dim_vehicle", whole)
    for load, at in ((LoadRange(19000101, 20200104), T1), (LoadRange(20200104, 20200110), T2)):
        whole = settle(load_scd2(whole, settle(cycle.stage_vehicle(stg, load)), VEHICLE, at))
        load_dimension(store, "dim_vehicle", stg, load, LoadContext(at, at))
    assert sorted(map(repr, store.read("dim_vehicle").collect())) == sorted(map(repr, whole.collect()))


def fact(spark, rows):
    values = [tuple({"transactiondate": d, "accountingdate": a, "policy_id": p, "amount": Decimal(1), "loaddate": at}.get(n) for n in FACT_POLICYTRANSACTION.names) for d, a, p, at in rows]
    return spark.createDataFrame(values, FACT_POLICYTRANSACTION)


def test_zone_map_prunes_partitions(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace_range(FACT, fact(spark, [(20200101 + d, 20200101 + d, d, T1) for d in range(20)]), LoadRange(20191231, 20200120), T1)
    # A late booking: an old day whose accounting month is new.
    store.replace_range(FACT, fact(spark, [(20200121, 20200121, 1, T2), (20200122, 20200201, 2, T2), (20200123, None, 3, T2)]), LoadRange(20200120, 20200131), T2)
    newest = store.read_zone(FACT, "loaddate", store.newest(FACT))
    assert sorted(r.transactiondate for r in newest.collect()) == [20200121, 20200122, 20200123]
    plan = plan_of(newest)
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert len(newest.inputFiles()) == 3
    month = store.read_zone(FACT, "accountingdate", store.newest(FACT, "accountingdate") // 100 * 100)
    assert [r.policy_id for r in month.collect()] == [2] and len(month.inputFiles()) == 1
    assert store.load_figures(FACT, T2) == store.metrics[FACT].__class__(23, 3, T2)
    assert store.load_figures(FACT, T1) is None  # later loads lie on top
    assert store.read_zone(FACT, "accountingdate", 20300101).isEmpty()


@pytest.mark.parametrize("grain", ["day", "month"])
def test_a_reload_that_dies_leaves_the_old_state(spark, tmp_path, grain, monkeypatch):
    """Written and emptied parts become visible together, with the pointer."""
    store, load = Store(spark, str(tmp_path), grain), LoadRange(20200101, 20200331)
    store.replace_range(FACT, fact(spark, [(20200110, 20200110, 1, T1), (20200210, 20200210, 2, T1)]), load, T1)
    again = fact(spark, [(20200210, 20200210, 3, T2), (20200305, 20200305, 4, T2)])
    shown = lambda: sorted(r.policy_id for r in store.read(FACT).collect())
    with monkeypatch.context() as broken:
        broken.setattr(Store, "write_small", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.replace_range(FACT, again, load, T2)
    assert shown() == [1, 2]
    old = store.read(FACT)
    store.replace_range(FACT, again, load, T2)
    assert shown() == [3, 4]
    assert sorted(r.policy_id for r in old.collect()) == [1, 2]  # a reader that began before
    with pytest.raises(ValueError, match="not among"):
        store.replace_parts(FACT, again, lambda part: False)
    assert shown() == [3, 4]


def test_one_exchange_of_the_facts_for_all_keys_of_a_policy(spark):
    """With broadcasts off: one exchange of the facts and one of each dimension, no other."""
    facts = spark.createDataFrame([(1, "1", "1", T1, 5), (None, None, "1", None, 6)], "p long, a string, b string, at timestamp_ntz, amount int")
    policies = spark.createDataFrame([(1, 1)], "policy_uniqueid long, policy_id long")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled") if spark.conf.get(k, None) is not None}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stored = settle(unknown_member(spark, "dim_vehicle", T0))
        drivers = settle(unknown_member(spark, "dim_driver", T0))
        entity = F.concat_ws("_", "p", "a")
        rows = owner_lookups(settle(facts), "p", {"policy_id": (settle(policies), "policy_uniqueid", 0)}, [
            History(stored, VEHICLE, entity, F.col("at"), 1), History(drivers, DRIVER, F.concat_ws("_", "p", "b"), F.col("at"), 1),
        ])
        plan = plan_of(rows)
        assert plan.count("Exchange hashpartitioning(") + plan.count("ReusedExchange") == 4 and "Broadcast" not in plan
        on_facts = [line for line in plan.splitlines() if "Exchange hashpartitioning(p#" in line]
        assert len(on_facts) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        for key, value in kept.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(rows_per_group=10), SkewPolicy(versions_per_probe=2), SkewPolicy(rows_per_group=10, versions_per_probe=2)])
def test_owner_lookups_equal_one_lookup_each(spark, policy):
    """Plain, with hot policies in slices, with policies of many versions, and both."""
    at = lambda k: datetime(2020, 1, 1 + k)
    versions = [(f"{p}_{r}-{k}", at(3 * k), at(3 * k + (3 if k % 2 else 2)), f"{p}_{r}") for p in range(5) for r in range(3) for k in range(p + 1)]
    versions += [("twin", at(0), at(9), "3_0"), ("empty", at(4), at(4), "1_1"), ("none", at(0), at(9), None), ("Unknown", at(0), at(9), "Unknown")]
    dim = spark.createDataFrame(versions, "vehicle_id string, valid_fromdate timestamp_ntz, valid_todate timestamp_ntz, vehicle_uniqueid string")
    rows = [(p, str(r), at(k), k) for p in (0, 1, 2, 3, 4, 9) for r in range(3) for k in range(14)]
    rows += [(4, "0", at(1), 50 + k) for k in range(60)] + [(None, "0", at(1), 200 + k) for k in range(30)] + [(2, None, at(1), 300), (2, "1", None, 301)]
    facts = settle(spark.createDataFrame(rows, "p long, r string, at timestamp_ntz, n int"))
    dim = settle(dim)
    entity = F.concat(F.col("p").cast("string"), F.lit("_"), F.col("r"))
    plain = settle(spark.createDataFrame([(p, 100 + p) for p in range(4)], "policy_uniqueid long, policy_id long"))
    want = point_in_time_lookup(facts, dim, VEHICLE, entity, F.col("at"))
    want = want.withColumn("policy_id", F.when(F.col("p") < 4, F.col("p") + 100).otherwise(0))
    dealt, slices = with_slices(facts, "p", policy)
    assert (slices is None) == (policy.rows_per_group > len(rows))
    got = owner_lookups(dealt, "p", {"policy_id": (plain, "policy_uniqueid", 0)}, [History(dim, VEHICLE, entity, F.col("at"))], slices, policy)
    columns = ["p", "r", "at", "n", "vehicle_id", "policy_id"]
    assert sorted(map(repr, got.select(columns).collect())) == sorted(map(repr, want.select(columns).collect()))
    if slices is not None:
        assert {r._slice for r in dealt.where("p = 4").collect()} != {0}


def test_summary_and_reconciliation_scan_no_table(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    clear_warehouse(store, LoadContext(T0, T0), spark.createDataFrame([(20200105,), (20200115,)], ORCHESTRATION_HISTORY))
    source = settle(spark.createDataFrame(ROWS, STG_PT))
    for at in (T1, T2):
        run_load_cycle(store, source, LoadContext(at, at))
    found = cycle.summary(store, T2)
    plan = plan_of(found)
    assert "FileScan" not in plan and "Scan parquet" not in plan
    scanned = cycle.control.daily_load_summary({name: store.read(name) for name in (*cycle.DIMS, FACT)}, T2)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, scanned.collect()))
    # Reconciled from figures alone: the stored fact is gone and nobody notices.
    store.clear(FACT)
    assert cycle._reconciled(store, source, LoadRange(20200105, 20200115), T2)
    assert not cycle._reconciled(store, source, LoadRange(19000101, 20200115), T2)
    # A store that has not written the load itself reads what it needs.
    other = Store(spark, str(tmp_path))
    assert sorted(r.table_name for r in cycle.summary(other, T2).collect()) == sorted((*cycle.DIMS, FACT))
    assert not cycle._reconciled(other, source, LoadRange(20200105, 20200115), T2)


def test_figures_that_differ():
    assert not checks.figures_differ((2, Decimal(3)), (2, Decimal(3))) and not checks.figures_differ((0, None), (0, Decimal(1)))
    assert checks.figures_differ((2, Decimal(3)), (1, Decimal(3))) and checks.figures_differ((2, Decimal(3)), (2, Decimal(4)))


def test_staged_files_load_once(spark, tmp_path):
    layout = STG_PT
    source = spark.createDataFrame(ROWS, layout)
    export = lambda low, high: export_range(source, LoadRange(low, high), f"{tmp_path}/export/{low}-{high}")
    load = lambda: load_staged_once(spark, f"{tmp_path}/export/*", layout, f"{tmp_path}/stg")
    export(19000101, 20200105)
    assert load() == 3 and load() == 0
    export(20200105, 20200115)
    assert load() == 1 and load() == 0
    rows = read_loaded(spark, layout, f"{tmp_path}/stg")
    assert rows.columns == layout.names
    want = source.where("transactiondate <= 20200115").collect()
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, want))


def test_a_staged_file_is_read_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "csv")
    texts = spark.range(20_000).select(F.lit(20200101).alias("transactiondate"), F.concat(F.lit("line\nbreak, \r\\n \"q\" "), F.col("id").cast("string")).alias("t"))
    export_range(texts.coalesce(1), LoadRange(20191231, 20200102), path)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        got = read_staged(spark, path, texts.schema)
        assert len(got.inputFiles()) == 1 and got.rdd.getNumPartitions() > 4
        assert got.exceptAll(texts).isEmpty() and got.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_an_operation_that_fails_stays_open_alone(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    clear_warehouse(store, LoadContext(T0, T0), spark.createDataFrame([(20200105,)], ORCHESTRATION_HISTORY))
    ticks = iter(range(60))
    ctx = LoadContext(T1, T1, clock=lambda: T1.replace(minute=next(ticks)))
    right = cycle.load_dimension
    monkeypatch.setattr(cycle, "load_dimension", lambda store, name, *a: 1 / 0 if name == "dim_driver" else right(store, name, *a))
    with pytest.raises(ZeroDivisionError):
        run_load_cycle(store, spark.createDataFrame(ROWS, STG_PT), ctx)
    log = {r.operation: r for r in operations(store).collect()}
    assert set(log) == set(cycle.DIMS) and [n for n, r in log.items() if r.enddate is None] == ["dim_driver"]
    ends = [r.enddate for r in log.values() if r.enddate]
    assert len(set(ends)) == 5 and min(ends) > T1 and {r.startdate for r in log.values()} == {T1}
    # The next run takes the load up, stages nothing twice, and folds the events into the table.
    monkeypatch.undo()
    result = run_load_cycle(store, spark.createDataFrame(ROWS, STG_PT), LoadContext(T2, T2.replace(hour=1)))
    assert result.load.high == 20200105 and result.staged_rows == 0 and result.reconciled and result.failed_checks == {}
    assert store.read("dbt_log").count() == 14 and not store.has(cycle.EVENTS)
    assert store.read("dbt_log").where("enddate IS NULL").count() == 1


def test_seeds_from_files(spark, tmp_path):
    (tmp_path / "dim_transaction.csv").write_text("transaction_id,transactioncd\n0,Unknown\n7,Own\n")
    (tmp_path / "orchestration_history.csv").write_text("transactiondate\n20200105\n")
    store = Store(spark, str(tmp_path / "dw"))
    clear_warehouse(store, LoadContext(T0, T0), seed_folder=str(tmp_path))
    assert sorted(map(tuple, store.read("dim_transaction").collect())) == [(0, "Unknown"), (7, "Own")]
    assert cycle.next_range(store) == LoadRange(19000101, 20200105)


def test_old_versions_and_settled_tables_go(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    cutoffs = [(20200103 + d,) for d in range(4)]
    clear_warehouse(store, LoadContext(T0, T0), spark.createDataFrame(cutoffs, ORCHESTRATION_HISTORY))
    source = settle(spark.createDataFrame(ROWS, STG_PT))
    local = Path(shared_root(spark).removeprefix("file:"))
    before = {p.name for p in local.iterdir()}
    for hour in range(4):
        run_load_cycle(store, source, LoadContext(T1.replace(hour=hour), T1.replace(hour=hour)), frozenset({"dims", "facts", "aggregates"}))
    assert {p.name for p in local.iterdir()} <= before
    for name in ("dim_coverage", "orchestration_log", "dim_vehicle.parts", f"{FACT}.parts"):
        assert len(store.versions(name)) == 2
    assert store.read(FACT).count() == 3 and store.read("dim_vehicle").count() == 4


def test_scope_keeps_what_was_there(spark):
    outside = settle(spark.range(3))
    with scope(spark):
        inside = settle(outside)
        with scope(spark):
            assert settle(inside).count() == 3
        assert inside.count() == 3
    assert outside.count() == 3
    with pytest.raises(Exception, match="(?i)not.*exist"):
        inside.count()


def test_discarded_tables_are_gone(spark):
    gone = settle(spark.range(3))
    files = gone.inputFiles()
    discard(gone, spark.range(1))
    assert files and not any(Path(f.removeprefix("file://").removeprefix("file:")).exists() for f in files)


def test_hot_path_costs_at_most_twice_the_windows_and_sorts(spark):
    staged = settle(spark.createDataFrame(
        [(f"k{i}", datetime(2020, 1, 1 + i % 28, i // 28), "1_1" if i % 3 else f"{i}_1", f"v{i % 5}", "m", "y", "f", "0") for i in range(300)], STG_VEHICLE,
    ))
    dim = settle(empty(spark, DIM_VEHICLE))
    counts = {}
    for name, policy in (("plain", SkewPolicy()), ("hot", SkewPolicy(rows_per_group=40))):
        plan = load_scd2(dim, staged, VEHICLE, T1, policy=policy)._jdf.queryExecution().sparkPlan().toString()
        counts[name] = plan.count("Window ["), plan.count("Sort [")
    # Beside the windows over rows there are two over the edge rows, of which there is one per piece.
    assert counts["hot"][0] <= 2 * counts["plain"][0] + 4, counts


def test_a_fact_that_is_read_once_is_not_written_first(spark):
    """Only what the aggregate reads several times is settled, and that without other columns."""
    from strataload.plans.queries import State

    state = State(spark, "/root/testdata/sf0.001")
    assert not [f for f in state.facts().inputFiles() if "/fact-" in f]
    state.all_dims(2)
    assert {"accountingdate", "policy_id"} <= set(state.fact(1).columns)


def test_a_history_store_loads_only_the_named_tables(spark):
    from strataload.plans.queries import history_store

    store = history_store(spark, "/root/testdata/sf0.001", "movements")
    assert store.pointer("movements") and not store.has("dim_vehicle") and not store.has("dim_coverage")


def test_keys_made_again_in_stored_parts_are_the_ones_given(spark, tmp_path):
    """A key that is not its row's hash, an empty one and a NULL one come back as they were."""
    from strataload.functions import version_key
    from strataload.schemas import STAMP, TABLES

    at = F.lit("2020-01-01 00:00:00").cast(STAMP)
    rows = spark.createDataFrame([("1_1", None, 0), ("1_2", "x", 1), ("1_3", "", 2), ("1_4", None, 3)], "e string, k string, n int")
    key = F.when(F.col("n") == 0, version_key(F.col("e"), at)).otherwise(F.col("k"))
    columns = {"vehicle_id": key, "valid_fromdate": at, "valid_todate": at, "vehicle_uniqueid": F.col("e"), "loaddate": at}
    whole = settle(rows.select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES["dim_vehicle"]]))
    store = Store(spark, str(tmp_path), buckets=2)
    store.write("dim_vehicle", whole)
    assert sorted(map(repr, store.read("dim_vehicle").collect())) == sorted(map(repr, whole.collect()))


def test_lines_travel_without_the_columns_their_values_are_made_of(spark):
    from strataload.sources.fixtures import VEHICLE_INPUTS, staging

    plan = staging(spark, "/root/testdata/sf0.001", VEHICLE_INPUTS)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joined = next(k for k, line in enumerate(plan) if "Join" in line)
    assert not any("l_partkey" in line or "l_quantity" in line for line in plan[:joined])


def test_arrived_rows_of_a_history_are_stored_without_their_hashes(spark, tmp_path, monkeypatch):
    stored = []
    monkeypatch.setattr(cycle, "settle", lambda df, name="step": stored.append(df.columns) or settle(df, name))
    stg = spark.createDataFrame([source_row(20200103, 1, "1", datetime(2020, 1, 1), "A", 1)], STG_PT)
    store = Store(spark, str(tmp_path), buckets=2)
    store.write_small("dim_vehicle", unknown_member(spark, "dim_vehicle", T0))
    load_dimension(store, "dim_vehicle", stg, LoadRange(20200101, 20200104), LoadContext(T1, T1))
    assert stored and all("vehicle_id" not in columns for columns in stored)

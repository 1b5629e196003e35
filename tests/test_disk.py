"""What a load keeps and sends over the disks (F1, load_cycle_two_batches)."""

from __future__ import annotations

import time
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from strataload.functions import LoadRange, version_key
from strataload.operators import checks
from strataload.operators.facts import build_fact, with_hashes
from strataload.operators.skew import SkewPolicy
from strataload.plans import cycle
from strataload.plans.cycle import FACT, LoadContext, clear_warehouse, run_load_cycle
from strataload.schemas import ORCHESTRATION_HISTORY, STG_PT, VEHICLE, unknown_member
from strataload.sources.fixtures import staging
from strataload.sources.scratch import freed_shuffles, settle
from strataload.sources.seeds import transaction_types
from strataload.sources.staged_csv import export_range, load_staged_once, read_loaded
from strataload.sources.store import Store
from test_cycle import ROWS, source_row

T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p.name for folder in folders for p in Path(folder.getPath()).rglob("shuffle_*.data")}


def test_a_query_inside_deletes_its_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(setting), shuffle_files(spark)
    with freed_shuffles(spark):
        found = spark.range(1000, numPartitions=4).groupBy((F.col("id") % 7).alias("k")).count()
        first = sorted(map(tuple, found.collect()))
    assert spark.conf.get(setting) == was
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:  # it goes on beside the next query
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    # A frame that runs again makes them again.
    assert len(first) == 7 and sorted(map(tuple, found.collect())) == first


def test_a_load_leaves_packed_exports_and_no_shuffle_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cycle, "EXPORT_ROWS", 2)
    store = Store(spark, str(tmp_path))
    clear_warehouse(store, LoadContext(T0, T0), spark.createDataFrame([(20200115,)], ORCHESTRATION_HISTORY))
    source, before = spark.createDataFrame(ROWS, STG_PT).coalesce(1), shuffle_files(spark)
    result = run_load_cycle(store, source, LoadContext(T1, T1))
    assert result.staged_rows == 4 and result.reconciled and result.failed_checks == {} and store.read(FACT).count() == 4
    exported = [p.name for p in (tmp_path / "export").rglob("part-*")]
    assert len(exported) == 2 and all(name.endswith(".csv.gz") for name in exported)
    assert all(p.name.endswith(".zstd.parquet") for p in (tmp_path / "stg_pt").rglob("part-*"))
    until = time.time() + 20
    while len(shuffle_files(spark) - before) > 4 and time.time() < until:
        time.sleep(0.2)
    assert len(shuffle_files(spark) - before) <= 4  # of the range before the load, and of the count above


def test_packed_exports_come_back_as_they_were(spark, tmp_path):
    texts = [None, "", "\\N", "a\nb\r\\r", ' "q", ']
    layout = "transactiondate int, t string"
    source = spark.createDataFrame([(20200101, t) for t in texts] + [(20200102, "plain")], layout)
    export_range(source.where("t IS NULL OR t <> 'plain'"), LoadRange(20191231, 20200101), f"{tmp_path}/export/1", 2)
    export_range(source, LoadRange(20200101, 20200102), f"{tmp_path}/export/2")  # one of before beside it
    assert load_staged_once(spark, f"{tmp_path}/export/*", source.schema, f"{tmp_path}/stg") == 6
    assert load_staged_once(spark, f"{tmp_path}/export/*", source.schema, f"{tmp_path}/stg") == 0
    rows = read_loaded(spark, source.schema, f"{tmp_path}/stg").collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, source.collect()))


def test_whole_staging_travels_as_lines_and_ends_by_order(spark):
    plan = staging(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [k for k, line in enumerate(plan) if "Join" in line]
    assert "l_orderkey" in plan[joins[0]] and "l_partkey" in plan[joins[1]]
    assert not any("AS limit2" in line or "AS accountingdate" in line for line in plan[joins[0]:])


def test_bare_facts_get_the_keys_of_whole_ones(spark, tmp_path):
    """Hashed, given and unknown versions; a policy of many versions; rows that are not bare."""
    at = lambda k: datetime(2020, 1, 1 + k)
    stg = settle(spark.createDataFrame([
        *[source_row(20200103, p, r, at(k), "A", 1) for p in (1, 2, 3) for r in ("1", "2") for k in range(6)],
        source_row(20200104, 2, None, at(3), "A", 1), source_row(20200104, None, "1", at(3), "A", 1),
    ], STG_PT))
    load, dims = LoadRange(20200101, 20200110), {}
    versions = [("1_1", at(1), at(3), False), ("1_1", at(3), at(9), True), ("2_1", at(0), at(2), False), *[("3_1", at(k), at(k + 1), False) for k in range(4)]]
    rows = spark.createDataFrame(versions, "e string, a timestamp_ntz, b timestamp_ntz, given boolean")
    for name in cycle.DIMS:
        dims[name] = unknown_member(spark, name, T0)
        if name in ("dim_vehicle", "dim_driver"):
            key = F.when(F.col("given"), F.lit("given")).otherwise(version_key(F.col("e"), F.col("a")))
            parts = iter([key, F.col("a"), F.col("b"), F.col("e")])
            history = rows.select(*[next(parts, F.lit(None)).cast(f.dataType).alias(f.name) for f in dims[name].schema])
            dims[name] = settle(dims[name].unionByName(history))
    dims["dim_transaction"] = transaction_types(spark)
    for policy in (SkewPolicy(), SkewPolicy(versions_per_probe=3)):
        whole = build_fact(stg, dims, load, T1, policy)
        bare = build_fact(stg, dims, load, T1, policy, bare=True)
        want = sorted(map(repr, whole.collect()))
        assert len(want) == 38 and sorted(map(repr, with_hashes(bare).collect())) == want
        keys = {r.vehicle_id for r in whole.collect()}
        assert {"Unknown", "given"} < keys and len(keys) == 8
        left = {r.vehicle_id for r in bare.where("policy_uniqueid < 3").collect()}
        assert left == {None, "Unknown", "given"}  # no hash travels
        # In a table kept by month, stored rows of the month come along without being bare.
        store = Store(spark, str(tmp_path / str(policy.versions_per_probe)), grain="month")
        for high, kept in ((20200103, 36), (20200110, 38)):
            part = LoadRange(20200101 if high == 20200103 else 20200103, high)
            store.replace_range(FACT, build_fact(stg, dims, part, T1, policy, bare=True), part, T1, with_hashes)
            assert store.read(FACT).count() == kept
        assert sorted(map(repr, store.read(FACT).collect())) == want
    assert VEHICLE.hashed


def test_both_checks_of_a_key_share_one_exchange(spark):
    keys = [None, "", "Unknown", "é", "0" * 32, "A" * 32, "ab" * 16, "ab" * 16, "é", None]
    child = [*keys, "cd" * 16, "cd" * 16, "x", "AB" * 16]
    parent, rows = (settle(spark.createDataFrame([(k,) for k in values], "k string").coalesce(1)) for values in (keys, child))
    twice, missing = checks.unique(parent, "k"), checks.relationships(rows, "k", parent, "k")
    assert twice.columns == missing.columns == ["k", "n_records"]
    assert sorted(map(tuple, twice.collect())) == [("ab" * 16, 2), ("é", 2)]
    assert sorted(map(tuple, missing.collect())) == [("AB" * 16, 1), ("cd" * 16, 2), ("x", 1)]
    numbers = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    assert [tuple(r) for r in checks.unique(numbers, "k").collect()] == [(1, 2)]
    assert [tuple(r) for r in checks.relationships(numbers, "k", spark.createDataFrame([("2",)], "k string"), "k").collect()] == [(1, 2)]
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for name in kept:
        spark.conf.set(name, "-1")
    try:
        both = twice.unionByName(missing)
        both.collect()
        plan = both._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert "ReusedExchange" in final and "Broadcast" not in final
    finally:
        for name, value in kept.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)

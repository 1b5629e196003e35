from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from model import OPEN, day, load as model_load
from strataload.operators.scd2 import close_intervals, detect_changes, load_scd2
from strataload.operators.skew import SkewPolicy
from strataload.schemas import DIM_DRIVER, DRIVER, STAMP, Scd2Spec, stamp, unknown_member
from strataload.sources.scratch import settle

SPEC = Scd2Spec(key="k", entity="e", change="at", tracked=("a", "b"))
STAGED = T.StructType([
    T.StructField("k", T.StringType()), T.StructField("e", T.StringType()), T.StructField("at", STAMP),
    T.StructField("a", T.StringType()), T.StructField("b", T.StringType()),
])
DIM = T.StructType([
    T.StructField("k", T.StringType()), T.StructField("valid_fromdate", STAMP), T.StructField("valid_todate", STAMP),
    T.StructField("e", T.StringType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType()),
    T.StructField("loaddate", STAMP),
])
LOADS = [datetime(2024, 1, d) for d in range(1, 10)]
BIG = SkewPolicy(broadcast_keys=0)
CUT = SkewPolicy(rows_per_group=2, broadcast_keys=0)


def row(entity: str, when: int | None, a: str | None, b: str | None = "x") -> dict:
    return {"key": f"{entity}|{when}", "entity": entity, "start": day(when), "values": (a, b)}


def staged_frame(spark, rows):
    return spark.createDataFrame([(r["key"], r["entity"], r["start"], *r["values"]) for r in rows], STAGED)


def run(spark, batches, policy=SkewPolicy(), null_mode="reference"):
    dim = spark.createDataFrame([], DIM)
    for rows, at in zip(batches, LOADS):
        dim = load_scd2(dim, staged_frame(spark, rows), SPEC, at, null_mode, policy)
    return collected(dim)


def collected(dim):
    return sorted(
        [(r.e, r.valid_fromdate or datetime.max, r.valid_todate, r.k, r.a, r.b, r.loaddate) for r in dim.collect()],
        key=repr,
    )


def modelled(batches, null_mode="reference"):
    dim = []
    for rows, at in zip(batches, LOADS):
        dim = model_load(dim, rows, at, null_mode)
    return sorted(
        [(r["entity"], r["start"] or datetime.max, r["end"], r["key"], *r["values"], r["loaddate"]) for r in dim],
        key=repr,
    )


EXAMPLES = {
    "repeated_value": ([[("E", 0, "A"), ("E", 31, "A"), ("E", 60, "B")]], [("A", 0, 60), ("B", 60, None)]),
    "backdated": (
        [[("E", 0, "A"), ("E", 60, "B")], [("E", 31, "C")]], [("A", 0, 31), ("C", 31, 60), ("B", 60, None)],
    ),
    "L8_backdated_equal_to_successor": (
        [[("E", 0, "A"), ("E", 60, "B")], [("E", 31, "B")]], [("A", 0, 31), ("B", 31, 60), ("B", 60, None)],
    ),
    "backdated_before_all_history": ([[("E", 31, "A")], [("E", 0, "A")]], [("A", 0, 31), ("A", 31, None)]),
    "L5_same_key_other_value": ([[("E", 0, "A")], [("E", 0, "B")]], [("A", 0, None)]),
    "L25_lost_restatement": ([[("E", 0, "A"), ("E", 60, "A")], [("E", 31, "B")]], [("A", 0, 31), ("B", 31, None)]),
    "L6_value_null_value": (
        [[("E", 0, "A"), ("E", 31, None), ("E", 60, "A")]], [("A", 0, 60), ("A", 60, None)],
    ),
}


@pytest.mark.parametrize("name", EXAMPLES)
@pytest.mark.parametrize("policy", [SkewPolicy(), BIG], ids=["small", "big"])
def test_worked_examples(spark, name, policy):
    batches, expected = EXAMPLES[name]
    rows = run(spark, [[row(e, n, v, None) for e, n, v in batch] for batch in batches], policy)
    assert [(r[4], r[1], r[2]) for r in rows] == [
        (value, day(start), OPEN if end is None else day(end)) for value, start, end in expected
    ]


def test_L6_all_null_row_is_dropped_and_null_mode_keeps_it(spark):
    batch = [[row("E", 0, None, None), row("E", 5, "A", None)]]
    assert [r[4] for r in run(spark, batch)] == ["A"]
    assert [r[4] for r in run(spark, batch, null_mode="null_safe")] == [None, "A"]
    with pytest.raises(ValueError):
        run(spark, batch, null_mode="other")


def test_L9_L10_untouched_entities_and_load_stamps_stay(spark):
    rows = run(spark, [
        [row("E", 0, "A"), row("F", 0, "A"), row("G", 0, "A")],
        [row("E", 9, "B"), row("F", 9, "A")],
    ])
    by_entity = {}
    for r in rows:
        by_entity.setdefault(r[0], []).append((r[2], r[6]))
    assert by_entity["E"] == [(day(9), LOADS[0]), (OPEN, LOADS[1])]
    assert by_entity["F"] == [(OPEN, LOADS[0])]
    assert by_entity["G"] == [(OPEN, LOADS[0])]


def test_L11_null_change_date_sorts_last(spark):
    rows = run(spark, [[row("E", None, "Z"), row("E", 0, "A"), row("E", 5, "B")]])
    assert [(r[4], r[2]) for r in rows] == [("A", day(5)), ("B", OPEN), ("Z", OPEN)]


def test_unknown_member_is_left_alone(spark):
    dim = unknown_member(spark, "dim_driver", LOADS[0])
    staged = spark.createDataFrame(
        [("k1", day(0), "1_0", "F", None, "S", "0")],
        "driver_id string, transactioneffectivedate timestamp_ntz, driver_uniqueid string, gendercd string, "
        "birthdate string, maritalstatuscd string, pointscharged string",
    )
    after = load_scd2(dim, staged, DRIVER, LOADS[1])
    assert after.schema.names == DIM_DRIVER.names
    rows = {r.driver_id: (r.valid_todate, r.loaddate) for r in after.collect()}
    assert rows == {"Unknown": (datetime(3000, 1, 1), LOADS[0]), "k1": (OPEN, LOADS[1])}


def history(seed: int, entities: int, rows: int, nulls: bool, hot: bool) -> list[dict]:
    rng = random.Random(seed)
    values = ["A", "B", "C"] + ([None] if nulls else [])
    made = {}
    for _ in range(rows):
        entity = "HOT" if hot and rng.random() < 0.7 else f"E{rng.randrange(entities)}"
        when = rng.randrange(200)
        made[(entity, when)] = row(entity, when, rng.choice(values), rng.choice(values))
    return list(made.values())


def batches_of(seed, rows, n=3):
    rng = random.Random(seed)
    parts = [[] for _ in range(n)]
    for r in rows:
        parts[rng.randrange(n)].append(r)
        if rng.random() < 0.1:
            parts[rng.randrange(n)].append(dict(r, values=("Q", "Q")))
    return [list({r["key"]: r for r in part}.values()) for part in parts]


@pytest.mark.parametrize("null_mode", ["reference", "null_safe"])
@pytest.mark.parametrize("policy", [SkewPolicy(), BIG, CUT], ids=["small", "big", "cut"])
def test_random_histories_match_the_model(spark, policy, null_mode):
    batches = batches_of(7, history(11, 12, 260, nulls=True, hot=True))
    assert run(spark, batches, policy, null_mode) == modelled(batches, null_mode)


@pytest.mark.parametrize("seed", range(3))
def test_cut_entities_match_the_model(spark, seed):
    """One entity with most of the rows, cut into pieces, in one load and in two."""
    batches = batches_of(seed, history(seed + 100, 3, 200, nulls=seed % 2 == 0, hot=True), n=2)
    assert run(spark, batches, CUT) == modelled(batches)


def test_intervals_are_contiguous_and_a_rerun_changes_nothing(spark):
    batches = batches_of(3, history(5, 10, 150, nulls=True, hot=False), n=2)
    first = run(spark, batches)
    again = run(spark, [*batches, batches[-1]])
    assert again == first
    by_entity = {}
    for r in first:
        by_entity.setdefault(r[0], []).append(r)
    for versions in by_entity.values():
        versions.sort(key=lambda v: v[1])
        ends = [v[2] for v in versions]
        assert ends[:-1] == [v[1] for v in versions[1:]] and ends[-1] == OPEN


def test_ordered_split_equals_one_load_without_nulls(spark):
    rows = history(21, 8, 120, nulls=False, hot=False)
    early = [r for r in rows if r["start"] < day(100)]
    late = [r for r in rows if r["start"] >= day(100)]
    whole = [r[:6] for r in run(spark, [rows])]
    assert [r[:6] for r in run(spark, [early, late])] == whole


def test_detect_and_close_give_the_same_as_the_whole_load(spark):
    batches = batches_of(9, history(31, 6, 90, nulls=True, hot=False), n=2)
    first = spark.createDataFrame([], DIM)
    first = load_scd2(first, staged_frame(spark, batches[0]), SPEC, LOADS[0])
    staged = staged_frame(spark, batches[1])
    kept = detect_changes(first, staged, SPEC, LOADS[1])
    inserted = first.unionByName(kept.withColumn("valid_todate", F.lit(None).cast(STAMP)))
    closed = close_intervals(inserted.withColumn("loaddate", F.coalesce("loaddate", stamp(LOADS[1]))), kept, SPEC)
    assert collected(closed) == modelled(batches)


def test_one_shuffle_and_one_sort_per_load(spark, tmp_path):
    """The three window steps share the partitioning and the order of the merged rows."""
    rows = history(1, 5, 50, nulls=False, hot=False)
    path = str(tmp_path / "dim")
    load_scd2(spark.createDataFrame([], DIM), staged_frame(spark, rows), SPEC, LOADS[0]).write.parquet(path)
    plan = load_scd2(
        spark.read.parquet(path), staged_frame(spark, rows), SPEC, LOADS[1], policy=SkewPolicy(broadcast_keys=10**6)
    )._jdf.queryExecution().executedPlan().toString()
    merged = plan.split("BroadcastHashJoin")[0]
    assert merged.count("Window [") == 3
    assert merged.count("Exchange hashpartitioning(e#") == 1
    assert merged.count("Sort [") == 1


def test_versions_within_a_second_and_known_keys_at_other_times(spark):
    """A known key is dropped wherever its staged row lies in time; sub-second neighbours stay apart."""
    from strataload.functions.keys import version_key

    at = [datetime(2024, 1, 1, 12, 0, 0, us) for us in (500_000, 100_000, 700_000)]
    keys = spark.createDataFrame([("E", t) for t in at], "e string, at timestamp_ntz").select(version_key(F.col("e"), F.col("at")))
    assert len(set(keys.collect())) == 3
    first = [row("E", 5, "A"), row("E", 9, "B")]
    moved = dict(row("E", 9, "C"), start=day(2))
    dim = load_scd2(spark.createDataFrame([], DIM), staged_frame(spark, first), SPEC, LOADS[0])
    dim = load_scd2(dim, staged_frame(spark, [moved]), SPEC, LOADS[1])
    assert collected(dim) == modelled([first, [moved]])


def test_hashed_keys_meet_in_one_shuffle_without_a_join(spark):
    """Like keys of any kind, but staged rows of stored keys are dropped where they meet."""
    from dataclasses import replace

    from strataload.functions.keys import version_key
    from strataload.schemas import VEHICLE, unknown_member
    from strataload.sources.scratch import settle

    def batch(seed: int):
        rows = [(f"{i % 6}_1" if i % 11 else None, day(i * 7 % 40), f"v{(i * seed) % 3}", "m", "y", "f", "0") for i in range(seed, 60, 2)]
        names = "vehicle_uniqueid string, transactioneffectivedate timestamp_ntz, vin string, model string, modelyr string, manufacturer string, estimatedannualdistance string"
        frame = spark.createDataFrame(list({r[:2]: r for r in rows}.values()), names)
        return settle(frame.withColumn("vehicle_id", version_key(F.col("vehicle_uniqueid"), F.col("transactioneffectivedate"))))

    batches, policy, found = [batch(1), batch(2), batch(1)], SkewPolicy(broadcast_keys=0), []
    for spec in (VEHICLE, replace(VEHICLE, hashed=False)):
        dim = settle(unknown_member(spark, "dim_vehicle", LOADS[0]))
        for staged, at in zip(batches, (*LOADS, LOADS[-1])):
            changed = detect_changes(dim, staged, spec, at, policy=policy)
            loaded = load_scd2(dim, staged, spec, at, policy=policy)
            if spec.hashed:
                plans = [df._jdf.queryExecution().executedPlan().toString() for df in (changed, loaded)]
                assert all("Join" not in p and p.count("Exchange hashpartitioning") == 1 for p in plans)
            changes = sorted(map(repr, changed.collect()))
            dim = settle(loaded)
            found.append((changes, sorted(map(repr, dim.collect()))))
    assert found[:3] == found[3:] and len(found[1][1]) > len(found[0][1]) > 1


def test_many_stored_keys_are_shuffled_not_broadcast(spark):
    from strataload.operators.scd2 import new_rows

    dim = settle(spark.range(2000).select(F.col("id").cast("string").alias("event_key")))
    staged = settle(spark.range(1990, 2010).select(F.col("id").cast("string").alias("event_key")))
    found = new_rows(dim, staged, "event_key", many=True)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(int(r[0]) for r in found.collect()) == list(range(2000, 2010))

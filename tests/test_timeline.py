from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from model import day
from strataload.functions import entity_id
from strataload.operators.ids import allocate_ids, highest_id
from strataload.operators.lookup import lookup, point_in_time_lookup
from strataload.operators.skew import PIECE, SkewPolicy, profile
from strataload.operators.timeline import Timeline
from strataload.schemas import Scd2Spec

CUT = SkewPolicy(rows_per_group=10)
ROWS = [("hot", day(i), f"k{i}", None if i % 3 else f"v{i}") for i in range(120)]
ROWS += [("hot", None, "kn", "vn")] + [(f"c{i % 7}", day(i), f"q{i}", f"w{i}") for i in range(40)]
NULLS = [(None, day(i), f"n{i}", f"x{i}" if i % 7 == 0 else None) for i in range(30)]
LAYOUT = "e string, at timestamp_ntz, k string, v string"


def neighbours(rows):
    """Previous key, next key and newest value so far, row by row."""
    found = {}
    for entity in {r[0] for r in rows}:
        line = sorted([r for r in rows if r[0] == entity], key=lambda r: (r[1] or datetime.max, r[2]))
        newest = None
        for i, r in enumerate(line):
            newest = r[3] or newest
            found[r[2]] = (
                line[i - 1][2] if i else None, line[i + 1][2] if i + 1 < len(line) else None, newest,
                any(x[3] == "v60" for x in line),
            )
    return found


@pytest.mark.parametrize("policy", [SkewPolicy(), CUT], ids=["plain", "cut"])
def test_neighbours_are_the_same_with_and_without_cuts(spark, policy):
    df = spark.createDataFrame(ROWS + NULLS, LAYOUT)
    line = Timeline.over(df, "e", ("at", "k"), policy)
    assert (line.cuts is None) == (policy.rows_per_group > len(ROWS))
    rows = line.place(df)
    if line.cuts is not None:
        sizes = {r[PIECE]: r["n"] for r in rows.where("e = 'hot'").groupBy(PIECE).agg(F.count("*").alias("n")).collect()}
        assert len(sizes) >= 3 and max(sizes.values()) <= 60
        nulls = rows.where("e IS NULL").groupBy(PIECE).count().collect()
        assert len(nulls) >= 2 and all(r[PIECE] is not None for r in nulls)
        assert rows.where(f"e <> 'hot' AND {PIECE} IS NOT NULL").isEmpty()
    rows = line.previous(rows, ["k"], "before")
    rows = line.following(rows, ["k"], "after")
    rows = line.carried(rows, F.col("v"), "newest")
    rows = line.done(line.anywhere(rows, F.coalesce(F.col("v") == "v60", F.lit(False)), "has"))
    got = {r.k: (r.before and r.before.k, r.after and r.after.k, r.newest, r.has) for r in rows.collect()}
    assert got == neighbours(ROWS + NULLS)


def test_pieces_are_many_but_their_tasks_are_not(spark):
    """also rows of equal time are cut, and the files of the placed rows follow the cores."""
    rows = [("hot", day(i // 40), f"k{i:04d}", f"v{i}") for i in range(2000)]
    df = spark.createDataFrame(rows, LAYOUT)
    line = Timeline.over(df, "e", ("at", "k"), CUT)
    placed = line.place(df)
    assert len(placed.inputFiles()) <= spark.sparkContext.defaultParallelism
    sizes = [r["count"] for r in placed.groupBy(PIECE).count().collect()]
    assert len(sizes) >= 200 and max(sizes) <= 10
    out = line.previous(line.following(placed, ["k"], "after"), ["k"], "before").collect()
    got = {r.k: (r.before and r.before.k, r.after and r.after.k) for r in out}
    assert got == {k: found[:2] for k, found in neighbours(rows).items()}


def test_known_bound_saves_the_measuring(spark):
    df = spark.createDataFrame(ROWS, LAYOUT)
    assert Timeline.over(df, "e", ("at", "k"), CUT, at_most=10).cuts is None
    found = profile(df, "e")
    assert (found.keys, found.rows, found.largest) == (8, 161, 121)
    assert profile(df.limit(0), "e").largest == 0


SPEC = Scd2Spec(key="k", entity="e", change="at", tracked=())
VERSIONS = [("1_A", f"a{i}", day(10 * i), day(10 * i + 10)) for i in range(20)]
VERSIONS += [("2_B", "b0", day(5), datetime(3000, 12, 31)), ("1_A", "empty", day(30), day(30))]


@pytest.mark.parametrize("policy", [
    SkewPolicy(), SkewPolicy(versions_per_probe=0), SkewPolicy(versions_per_probe=0, rows_per_group=10),
], ids=["range join", "timeline", "cut timeline"])
def test_L3_L4_point_in_time_is_half_open(spark, policy):
    dim = spark.createDataFrame(VERSIONS, "e string, k string, valid_fromdate timestamp_ntz, valid_todate timestamp_ntz")
    facts = [(n, 1, "A", day(n)) for n in range(-3, 205)] + [(500, 2, "B", day(4)), (501, 2, "B", day(5)),
             (502, 2, None, day(9)), (503, 2, "B", None), (504, 3, "C", day(1)), (505, 2, "B", day(5))]
    df = spark.createDataFrame(facts, "id int, p int, r string, at timestamp_ntz")
    out = point_in_time_lookup(df, dim, SPEC, entity_id("p", "r"), F.col("at"), policy=policy)
    assert out.columns == ["id", "p", "r", "at", "k"]
    got = {r.id: r.k for r in out.collect()}

    def expected(p, r, at):
        if r is None or at is None:
            return "Unknown"
        return next((k for e, k, a, b in VERSIONS if e == f"{p}_{r}" and a <= at < b), "Unknown")

    assert got == {i: expected(p, r, at) for i, p, r, at in facts}
    assert out.count() == len(facts)


@pytest.mark.parametrize("bound", [512, 2, 0])
def test_of_overlapping_versions_the_later_decides(spark, bound):
    """Also when only one of two entities is beyond the bound."""
    rows = [("1_A", "a", day(0), day(50)), ("1_A", "b", day(10), day(20)), ("1_A", "c", day(10), day(15)), ("2_B", "d", day(0), day(30)),
            (None, "e", day(0), day(50))]
    dim = spark.createDataFrame(rows, "e string, k string, valid_fromdate timestamp_ntz, valid_todate timestamp_ntz")
    facts = [(n, p, r, day(n)) for n in (5, 12, 17, 25) for p, r in ((1, "A"), (2, "B"), (3, None))]
    df = spark.createDataFrame(facts, "id int, p int, r string, at timestamp_ntz")
    out = point_in_time_lookup(df, dim, SPEC, entity_id("p", "r"), F.col("at"), policy=SkewPolicy(versions_per_probe=bound))
    got = {(r.id, r.p): r.k for r in out.collect()}
    assert out.count() == len(facts)
    assert [got[n, 1] for n in (5, 12, 17, 25)] == ["a", "b", "b", "Unknown"]
    assert {got[n, 2] for n in (5, 12, 17, 25)} == {"d"} and {got[n, 3] for n in (5, 12, 17, 25)} == {"Unknown"}


def test_L21_lookup_defaults_on_null_and_miss(spark):
    dim = spark.createDataFrame([(0, "~", "~"), (1, "a", "b"), (2, "~", "b")], "id int, x string, y string")
    facts = spark.createDataFrame(
        [(1, "a", "b"), (2, None, "b"), (3, "~", "~"), (4, "z", "z"), (5, "~", "b")], "n int, x string, y string"
    )
    out = lookup(facts, dim, {"x": "x", "y": "y"}, "id", 0)
    assert {r.n: r.id for r in out.collect()} == {1: 1, 2: 0, 3: 0, 4: 0, 5: 2}


def test_allocated_ids_are_dense_and_in_order(spark):
    df = spark.createDataFrame([(f"{i * 37 % 101:03d}", i % 5) for i in range(101)], "a string, b int").repartition(6)
    out = {(r.a, r.b): r.id for r in allocate_ids(df, "id", ["a", "b"], 1000).collect()}
    ordered = sorted(out)
    assert [out[k] for k in ordered] == list(range(1001, 1102))


def test_L20_ids_start_at_one_over_an_empty_table(spark):
    none = spark.createDataFrame([], "id long, a string")
    df = spark.createDataFrame([("y",), ("x",), (None,)], "a string")
    out = allocate_ids(df, "id", ["a"], highest_id(none, "id"))
    assert {r.a: r.id for r in out.collect()} == {"x": 1, "y": 2, None: 3}
    assert allocate_ids(df.limit(0), "id", ["a"], 5).count() == 0

"""Vector codes and neighbour search against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from strataload.llm import collisions, queries, vectorcode

VECTORS = "vec_id long, embedding array<double>, label int, code string, v int, dim int, block int"


def frame(spark, rows):
    """Rows of (vec_id, embedding, label) with extra columns of clashing names."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], VECTORS)


def test_sequency_order_counts_sign_changes():
    waves = vectorcode.transform(np.eye(16, dtype=np.int64)).T  # row j: the j-th wave
    assert [(np.diff(np.sign(w)) != 0).sum() for w in waves] == list(range(16))
    assert (waves @ waves.T == 16 * np.eye(16)).all()


@settings(max_examples=60, deadline=None)
@given(
    st.integers(1, 21), st.integers(1, 40), st.integers(1, 30), st.sampled_from([2, 50, 10**4]),
    st.sampled_from([np.int32, np.int64]), st.integers(0, 10**6),
)
def test_nearest_is_exact_with_ties_to_the_lower_index(length, found, entries, size, kind, seed):
    rng = np.random.default_rng(seed)
    if kind is np.int32:
        size = min(size, 50)
    x, c = (rng.integers(-size, size + 1, (k, length)).astype(kind) for k in (found, entries))
    c[rng.integers(0, entries)] = c[0]
    want = ((x[:, None].astype(np.int64) - c[None]) ** 2).sum(2)
    seen = vectorcode.transform(x)
    index, error = vectorcode.nearest(seen, vectorcode.transform(c))
    assert (index == want.argmin(1)).all() and (error == want.min(1) * seen.shape[1]).all()


def brute_codes(rows, parts, entries, rounds, scale):
    kept = [(i, [math.floor(scale * x) for x in v], g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    dim = -(-max(1, *(len(v) for _, v, _ in kept)) // parts) * parts
    kept = [(i, v + [0] * (dim - len(v)), g) for i, v, g in kept]
    first = sorted({i for i, _, _ in kept}, key=lambda i: (i is None, i))[:entries]
    width = dim // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(min(v for j, v, _ in kept if j == i), p) for i in first] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v, p: min((apart(cut(v, p), b), e) for e, b in enumerate(books[p]))
    for _ in range(rounds):
        groups = {}
        for _, v, _ in kept:
            for p in range(parts):
                groups.setdefault((p, nearest(v, p)[1]), []).append(cut(v, p))
        for (p, e), members in groups.items():
            books[p][e] = [sum(x) // len(members) for x in zip(*members)]
    out = []
    for i, v, g in kept:
        found = [nearest(v, p) for p in range(parts)]
        out.append((i, g, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    totals = {}
    for _, g, _, d in out:
        totals[g] = totals.get(g, 0) + d
    return sorted(((i, g, c, d, totals[g]) for i, g, c, d in out), key=repr), books


@pytest.mark.parametrize(("dim", "size"), [(12, 1.0), (8, 3000.0), (10, 0.01)])
def test_codes_equal_brute_force(spark, dim, size):
    rng = np.random.default_rng(dim)
    rows = [(i, rng.normal(0, size, dim).tolist(), i % 3 if i % 7 else None) for i in range(90)]
    rows += [(5, rows[5][1], 5), (5, rows[6][1], 1), (None, rows[7][1], 1), (100, None, 1), (101, [None] * dim, 1), (102, [math.inf] * dim, 1)]
    rows += [(103, [float("nan")] * dim, None), (104, [], 2), (105, [1.0, 2.0], 2), (106, [0.0] * dim, 2)]
    want, books = brute_codes(rows, 4, 10, 3, 1024)
    got, got_books = vectorcode.compress(frame(spark, rows), entries=10, rounds=3)
    assert got_books.tolist() == books
    assert sorted(((r.vec_id, r.label, r.code, r.error, r.label_error) for r in got.collect()), key=repr) == want


def test_codes_of_few_or_no_vectors(spark):
    none, books = vectorcode.compress(frame(spark, [(1, None, 1)]))
    assert none.columns == ["vec_id", "label", "code", "error", "label_error"] and none.isEmpty() and books.size == 0
    only, _ = vectorcode.compress(frame(spark, [(None, [], None)]))
    assert [tuple(r) for r in only.collect()] == [(None, None, "00000000", 0, 0)]
    with pytest.raises(ValueError):
        vectorcode.compress(frame(spark, [(1, [1e30], 1)]))


def brute_neighbours(rows, k):
    good = [(i, np.array(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q in sorted({i for i, _ in good if i % 50 == 0}):
        a = min((v.tolist() for i, v in good if i == q))
        a = np.array(a) / np.abs(a).max()
        scores = []
        for i, v in good:
            if i != q and len(v) == len(a):
                v = v / np.abs(v).max()
                scores.append((-(a @ v) / math.sqrt((a @ a) * (v @ v)), i))
        if scores:
            out[q] = sorted(scores)[:k]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((-r.score, r.vec_id))
    return out


def test_neighbours_of_edge_rows(spark):
    """With so few rows the windows take in everything, so the answer is exact."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 4).tolist(), 1) for i in range(0, 300, 10)]
    rows += [(7, rows[0][1], 1), (7, rows[0][1], 1), (50, rows[1][1], 1), (8, [x * 1e200 for x in rows[0][1]], 1), (9, [x * 1e-300 for x in rows[0][1]], 1)]
    rows += [(1000, None, 1), (1050, [0.0] * 4, 1), (1100, [None] * 4, 1), (1150, [math.nan] * 4, 1), (None, rows[0][1], 1), (1200, [], 1), (1250, [1.0], 1), (1300, [-2.0], 1)]
    want = brute_neighbours([r[:2] for r in rows], 5)
    for block, part in ((1000, 1000), (6, 2)):
        index = collisions.build_index(frame(spark, rows), "vec_id", "embedding", rows_per_block=block)
        asked = frame(spark, rows).filter("vec_id % 50 = 0")
        got = by_query(collisions.search(index, asked, "vec_id", "embedding", queries_per_part=part).collect())
        assert got.keys() == want.keys()
        for q in want:
            assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=0, atol=1e-12)
            assert [i for _, i in got[q]][:2] == [i for _, i in want[q]][:2]


def test_one_vector_repeated_by_most_rows(spark):
    rows = [(i, [1.0, 2.0, 3.0], 1) for i in range(3000)] + [(5000, [3.0, 2.0, 1.0], 1)]
    index = collisions.build_index(frame(spark, rows), "vec_id", "embedding", rows_per_block=500)
    got = by_query(collisions.search(index, frame(spark, rows).filter("vec_id in (0, 50, 5000)"), "vec_id", "embedding").collect())
    assert [i for _, i in got[0]] == [1, 2, 3, 4, 5] and [i for _, i in got[5000]] == [0, 1, 2, 3, 4]


def test_no_vectors(spark):
    index = collisions.build_index(frame(spark, []), "vec_id", "embedding")
    assert collisions.search(index, frame(spark, []), "vec_id", "embedding").isEmpty()


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    """Most of the true neighbours, with their exact cosines."""
    path = f"/root/testdata/{sf}"
    vectors = spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding")
    want = brute_neighbours([(r.vec_id, r.embedding) for r in vectors.collect()], 5)
    got = by_query(queries.op12_neighbours(spark, path).collect())
    assert got.keys() == want.keys() and all(len(got[q]) == 5 for q in got)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.95
    for q in want:
        true = {i: s for s, i in want[q]}
        assert all(abs(s - true[i]) < 1e-9 for s, i in got[q] if i in true)

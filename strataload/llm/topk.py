"""Exact top-k search by inner product over vector-approximation files.

Vectors are dealt to blocks of bounded size. A block's file holds, for every component,
a grid of 2**bits cells over the block's own range, each vector's cells in one byte per
component, and the exact vectors behind them. A search scans only the cells: they give
an upper and a lower bound of every score. Exact vectors are then read in the order of
their upper bounds, until the k-th best exact score is above the next bound, so the
block's k best are certain. The k best of a query's blocks are merged at last.

Every block of queries meets every block of vectors once, as a stated query set must: a
block's file comes first in its partition, is read once, and the queries' parts stream past it.
No pair of rows leaves a task but each block's k best per query.

Defined cases: every row of another id is a candidate, rows that repeat an id too. A repeated
query id is searched once, with its smallest vector. Vectors whose scaled inner products could leave
64 bits are refused with a ValueError.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataload.sources.scratch import settle

LIMIT = 2**53  # larger integers than this are not exact as doubles
FILE = "dim int, block int, n int, ids binary, low binary, width binary, high binary, cells binary, exact binary"
FOUND = "query_id long, vec_id long, score long"


def scaled(vector: Column, scale: int = 64) -> Column:
    """Components as floor(scale * x) of x as double; NULL for a vector that takes no part."""
    def cell(x: Column) -> Column:
        moved = x.cast("double") * scale
        return F.when(F.abs(moved) < LIMIT, F.floor(moved)).otherwise(F.raise_error(F.lit("a component is too large to be scaled exactly")).cast("long"))

    cells = F.transform(vector, cell)
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return F.when(~F.exists(vector, bad), cells)


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.stack(vectors.to_list()).reshape(len(vectors), dim).astype(np.int64)


def _file(rows: pd.DataFrame, bits: int) -> pd.DataFrame:
    dim, block = int(rows["dim"][0]), int(rows["block"][0])
    rows = rows.sort_values("vec_id", kind="stable")
    exact = _matrix(rows["v"], dim)
    low, high = exact.min(0), exact.max(0)
    width = (high - low) // 2**bits + 1
    cells = ((exact - low) // width).astype(np.uint8)
    parts = (rows["vec_id"].to_numpy(np.int64), low, width, high, cells, exact)
    return pd.DataFrame([(dim, block, len(rows), *[p.tobytes() for p in parts])], columns=[c.split()[0] for c in FILE.split(", ")])


def build_files(vectors: DataFrame, vector_col: str, rows_per_block: int = 8192, bits: int = 5) -> tuple[DataFrame, int]:
    """The approximation files of all vectors, and the number of blocks."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col(vector_col)).alias("v"))
    rows = rows.filter("vec_id is not null and v is not null").withColumn("dim", F.size("v"))
    blocks = -(-rows.count() // rows_per_block) or 1
    # By id and vector, so that an id with very many rows is spread over blocks too.
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))
    return settle(dealt.groupBy("dim", "block").applyInPandas(lambda x: _file(x, bits), FILE), "va-file"), blocks


def scan(low, width, high, cells, exact, ids, query_ids, queries, k: int):
    """The k best of one block for each query: lists of query id, vector id and score."""
    at_least = low + cells * width
    at_most = np.minimum(at_least + width - 1, high)
    largest = int(np.abs(exact).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(1, exact.shape[1])
    kind = np.float32 if largest < 2**23 else np.float64
    up, down = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
    lo, hi = at_least.astype(kind), at_most.astype(kind)
    upper, lower = up @ hi.T + down @ lo.T, up @ lo.T + down @ hi.T
    if largest >= 2**52:  # sums are rounded: widen the bounds
        slack = 1e-9 * (np.abs(queries).astype(kind) @ np.maximum(np.abs(lo), np.abs(hi)).T) + 1
        upper, lower = upper + slack, lower - slack
    if largest >= 2**62:
        raise ValueError("inner products may leave 64 bits")
    own = query_ids[:, None] == ids[None, :]
    upper[own] = lower[own] = -np.inf
    certain = np.partition(lower, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(queries), -np.inf)
    out = []
    for q in range(len(queries)):
        near = np.flatnonzero((upper[q] >= certain[q]) & ~own[q])
        near = near[np.argsort(-upper[q, near], kind="stable")]
        best_scores, best_ids = np.empty(0, exact.dtype), np.empty(0, np.int64)
        for at in range(0, len(near), 4 * k):
            if len(best_ids) == k and best_scores[-1] > upper[q, near[at]]:
                break
            read = near[at : at + 4 * k]
            best_scores = np.concatenate([best_scores, exact[read] @ queries[q]])
            best_ids = np.concatenate([best_ids, ids[read]])
            order = np.lexsort((best_ids, -best_scores))[:k]
            best_scores, best_ids = best_scores[order], best_ids[order]
        out.extend((int(query_ids[q]), int(i), int(s)) for i, s in zip(best_ids, best_scores))
    return out


def search(files: DataFrame, blocks: int, queries: DataFrame, vector_col: str, k: int = 20, queries_per_block: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best among all vectors but its own id's.

    Scores are inner products of scaled integer vectors of the same length; ties go to
    the smaller vec_id. Queries with no other vector of their length give no rows; a NULL
    or non-finite vector, or a NULL id, takes no part.
    """
    rows = queries.select(F.col("vec_id").cast("long").alias("query_id"), scaled(F.col(vector_col)).alias("v"))
    rows = rows.filter("query_id is not null and v is not null").groupBy("query_id").agg(F.min("v").alias("v"))
    rows = settle(rows.withColumn("dim", F.size("v")), "queries")
    parts = -(-rows.count() // queries_per_block) or 1

    def pack(x: pd.DataFrame) -> pd.DataFrame:
        dim = int(x["dim"][0])
        return pd.DataFrame({
            "dim": [dim], "part": [int(x["part"][0])],
            "query_ids": [x["query_id"].to_numpy(np.int64).tobytes()], "queries": [_matrix(x["v"], dim).tobytes()],
        })

    packed = (
        rows.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int"))
        .groupBy("dim", "part").applyInPandas(pack, "dim int, part int, query_ids binary, queries binary").drop("part")
    )
    asked = packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    stream = asked.unionByName(files, allowMissingColumns=True)
    dealt = stream.repartition(blocks, "dim", "block").sortWithinPartitions("dim", "block", F.col("n").asc_nulls_last())

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, file = None, None
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                read = lambda name, kind=np.int64, row=row: np.frombuffer(row[name], kind)
                if row["ids"] is not None:
                    here, shape = (row["dim"], row["block"]), (int(row["n"]), row["dim"])
                    file = (
                        read("low"), read("width"), read("high"), read("cells", np.uint8).reshape(shape),
                        read("exact").reshape(shape), read("ids"),
                    )
                elif here == (row["dim"], row["block"]):
                    ids = read("query_ids")
                    out += scan(*file, ids, read("queries").reshape(len(ids), row["dim"]), k)
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = dealt.mapInPandas(find, FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Approximate nearest neighbours by collision counting over sorted projections.

Every vector, brought to length 1, is projected on ``lines`` random directions, and each direction's
projections are kept as one sorted array. A query opens a window around its own projection in every
array and widens all of them together, by a constant ratio (virtual rehashing: nothing is hashed
anew, the windows only take in further neighbours in the arrays). A vector that has come into the windows of
``threshold`` of the lines' share is verified: its exact cosine is computed. The projections of two
vectors at distance d differ by a normal variable of deviation d, so a window of half-width h
holds a vector at distance d with chance 2 * Phi(h / d) - 1. A query ends once a vector as near as the k-th
best found would have passed the threshold with a chance of 1 - ``miss`` or more; windows that
have taken in everything end it too. Nothing caps how many vectors are verified.

Vectors are dealt to blocks of bounded size, each with arrays of its own. Blocks and queries meet
by a shuffle on the block in which the block's rows come first and the queries stream past it, so
a task holds one block and a batch of queries. The k best of a query's blocks are merged at last.

Defined cases:
* Vectors that are NULL, all zero or hold NULL or non-finite components, and rows without an id, take no part.
* Candidates are the rows of every other id; rows that repeat an id all count. A repeated query id is
  searched once, by its least vector. Only vectors of the same length meet.
* Ties go to the smaller vec_id. A query with no candidate gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataload.sources.scratch import settle

FILE = "dim int, block int, n int, ids binary, vectors binary, places binary, rows binary"
APART = 1000.0  # between two lines; a projection of a unit vector is far smaller
STREAM = "dim int, block int, part int, query_id long, v array<double>, n int, ids binary, vectors binary, places binary, rows binary"


@dataclass(frozen=True)
class Settings:
    lines: int = 64
    threshold: float = 0.55
    ratio: float = 1.25
    start: float = 0.05  # half-width of the first windows
    miss: float = 0.02
    seed: int = 12


@dataclass(frozen=True)
class Index:
    files: DataFrame
    blocks: int
    settings: Settings


def usable(vector: Column) -> Column:
    """Not NULL, all components present and finite, and not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def lengthened(vectors: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component to 1, so that no square leaves the range."""
    _, exponent = np.frexp(np.abs(vectors).max(1, keepdims=True))
    half = exponent // 2  # in two steps: the whole power may itself be out of range
    return np.ldexp(np.ldexp(vectors, -half), half - exponent)


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = lengthened(vectors)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def directions(dim: int, settings: Settings) -> np.ndarray:
    return np.random.default_rng([settings.seed, dim]).normal(size=(dim, settings.lines))


def _file(rows: pd.DataFrame, settings: Settings) -> pd.DataFrame:
    rows = rows.sort_values("vec_id", kind="stable")
    dim, vectors = int(rows["dim"].iloc[0]), np.stack(rows["v"].to_list())
    ids = rows["vec_id"].to_numpy(np.int64)
    places = (units(vectors) @ directions(dim, settings)).T.astype(np.float32)
    order = np.argsort(places, axis=1, kind="stable").astype(np.int32)
    places = np.take_along_axis(places, order, 1)
    parts = [x.tobytes() for x in (ids, vectors, places, order)]
    return pd.DataFrame([(dim, int(rows["block"].iloc[0]), len(ids), *parts)], columns=[c.split()[0] for c in FILE.split(", ")])


def build_index(vectors: DataFrame, id_col: str, vector_col: str, rows_per_block: int = 16384, settings: Settings = Settings()) -> Index:
    """Sorted projections of all usable vectors, in blocks of about ``rows_per_block`` rows."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = rows.select("vec_id", F.transform("v", lambda x: x.cast("double")).alias("v"), F.size("v").alias("dim"))
    blocks = -(-rows.count() // rows_per_block) or 1
    # By id and vector, so that an id with very many rows is spread over blocks too.
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))
    files = dealt.groupBy("dim", "block").applyInPandas(lambda x: _file(x, settings), FILE)
    return Index(settle(files, "projections"), blocks, settings)


class Block:
    """One block's vectors and sorted projections."""

    def __init__(self, dim: int, n: int, ids: bytes, vectors: bytes, places: bytes, rows: bytes, settings: Settings):
        self.settings = settings
        self.ids = np.frombuffer(ids, np.int64)
        self.vectors = lengthened(np.frombuffer(vectors).reshape(n, dim))
        self.norms = np.sqrt((self.vectors * self.vectors).sum(1))
        # All lines behind each other, each on a stretch of its own, so that one search finds all windows.
        places = np.frombuffer(places, np.float32).reshape(settings.lines, n)
        self.places = (np.clip(places, -APART / 4, APART / 4) + APART * np.arange(settings.lines)[:, None]).ravel()
        self.rows = np.frombuffer(rows, np.int32).astype(np.intp)
        self.directions = directions(dim, settings)
        self.need = math.ceil(settings.threshold * settings.lines)
        self.sure = sure_ratio(settings.lines, self.need, settings.miss)

    def search(self, query_id: int, vector: np.ndarray, k: int) -> list[tuple[int, int, float]]:
        """The query's k best of this block as (query_id, vec_id, cosine)."""
        query = lengthened(vector[None])[0]
        norm = math.sqrt(query @ query)
        centres = (query / norm) @ self.directions
        n, lines = len(self.ids), self.settings.lines
        counts = np.where(self.ids == query_id, -lines - 1, 0)  # the query's own rows never pass
        others = int((counts == 0).sum())
        found, scores = np.empty(0, np.int64), np.empty(0)
        line = np.arange(lines)
        first, last = line * n, line * n + n
        centres = centres + APART * line
        left = np.searchsorted(self.places, centres)
        right, width = left.copy(), self.settings.start
        while True:
            low = np.maximum(np.minimum(np.searchsorted(self.places, centres - width), left), first)
            high = np.minimum(np.maximum(np.searchsorted(self.places, centres + width, "right"), right), last)
            new = [self.rows[a:b] for ends in ((low, left), (right, high)) for a, b in zip(*ends) if a < b]
            if new:
                counts += np.bincount(np.concatenate(new), minlength=n)
            left, right = low, high
            passed = np.flatnonzero(counts >= self.need)
            if len(passed):
                counts[passed] = -lines - 1  # verified once
                found = np.concatenate([found, passed])
                scores = np.concatenate([scores, (self.vectors[passed] @ query) / (self.norms[passed] * norm)])
                if len(found) > k:
                    # Among equal scores at the end of the list all stay, to be ranked by id.
                    edge = np.partition(scores, -k)[-k]
                    seen = len(found)
                    found, scores = found[scores >= edge], scores[scores >= edge]
                    others -= seen - len(found)
            everything = bool((left == first).all() and (right == last).all())
            if everything or len(found) >= others:
                break
            if len(found) >= k:
                farthest = math.sqrt(max(0.0, 2 - 2 * np.partition(scores, -k)[-k]))
                if farthest <= width * self.sure:
                    break
            width *= self.settings.ratio
        order = np.lexsort((self.ids[found], -scores))[:k]
        return [(query_id, int(self.ids[i]), float(s)) for i, s in zip(found[order], scores[order])]


def sure_ratio(lines: int, need: int, miss: float) -> float:
    """The distance, as a multiple of the half-width, at which ``need`` of ``lines`` collide with a chance of 1 - miss."""
    def chance(x: float) -> float:
        p = math.erf(1 / (x * math.sqrt(2)))
        return sum(math.comb(lines, i) * p**i * (1 - p) ** (lines - i) for i in range(need, lines + 1))

    low, high = 1e-3, 1e3
    for _ in range(60):
        mid = math.sqrt(low * high)
        low, high = (mid, high) if chance(mid) >= 1 - miss else (low, mid)
    return low


def search(index: Index, queries: DataFrame, id_col: str, vector_col: str, k: int = 5, queries_per_part: int = 65536) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each query, by cosine.

    ``queries_per_part`` bounds the queries that stream past one copy of a block, and so a task's time.
    """
    rows = queries.select(F.col(id_col).cast("long").alias("query_id"), F.transform(vector_col, lambda x: x.cast("double")).alias("v"))
    rows = rows.filter(F.col("query_id").isNotNull() & usable(F.col("v"))).groupBy("query_id").agg(F.min("v").alias("v"))
    rows = settle(rows, "queries")
    parts = -(-rows.count() // queries_per_part) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int").alias("part")
    asked = rows.select(F.size("v").alias("dim"), part, "query_id", "v", every(index.blocks).alias("block"))
    stream = asked.unionByName(index.files.withColumn("part", every(parts)), allowMissingColumns=True).select(*[c.split()[0] for c in STREAM.split(", ")])
    settings = index.settings

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, block = None, None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.ids is not None:
                    here = (row.dim, row.block, row.part)
                    block = Block(row.dim, int(row.n), row.ids, row.vectors, row.places, row.rows, settings)
                elif here == (row.dim, row.block, row.part):
                    out += block.search(int(row.query_id), np.asarray(row.v), k)
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    key = ("dim", "block", "part")
    dealt = stream.repartition(index.blocks * parts, *key).sortWithinPartitions(*key, F.col("n").asc_nulls_last())
    found = dealt.mapInPandas(answer, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Vector code compression: product codes learnt and assigned in integers only.

Components become integers floor(scale * x), vectors are cut into consecutive parts, and
each part is replaced by the number of the nearest entry of its position's codebook.
Distances are compared after an integer Walsh-Hadamard transform of parts and entries,
both padded with zeros to a power of two, P. The transform multiplies every squared
distance by exactly P, and in sequency order (by sign changes) its first coefficients
hold the slow components of a part. So the squared differences are added up coefficient
by coefficient, and an entry whose partial sum already exceeds the whole distance of the
entry that leads is given up. All sums are integers, hence exact; the distance is the sum / P.

Each learning round is one pass over the stored integer vectors: tasks send one row of sums
per used entry, Spark adds them, and the driver holds the codebooks alone
(parts x entries x length of a part, whatever the size of the data).

Defined cases:
* A vector that is NULL, or holds a NULL or non-finite component, is dropped; without any other, no rows.
* Vectors are followed by zeros up to the longest one's length, rounded up to a multiple of ``parts``.
* Codebooks start from the smallest distinct ids, NULL last; of rows that repeat an id, from the least vector.
  Every kept row is coded, repeats and NULL ids too. With fewer ids than entries the codebooks are shorter.
* Components so large that a distance may leave 64 bits are refused with a ValueError.
* Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.sources.scratch import settle

ROWS = 512  # parts compared at once with all entries: a table that stays in a core's cache
STEP = 4  # coefficients added between two eliminations
DENSE = 0.25  # above this share of entries left, whole columns are cheaper than lists of survivors


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not NULL, and all components present and finite."""
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def sequency_order(length: int) -> np.ndarray:
    """Rows of the natural Walsh-Hadamard matrix, by their number of sign changes."""
    rows = np.arange(length)
    signs = np.array([[bin(i & j).count("1") & 1 for j in rows] for i in rows])
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard transform of the rows of x, padded with zeros, in sequency order."""
    length = 1 << max(0, x.shape[1] - 1).bit_length()
    out = np.zeros((len(x), length), x.dtype)
    out[:, : x.shape[1]] = x
    half = 1
    while half < length:
        pairs = out.reshape(len(x), -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), length)
        half *= 2
    return out[:, sequency_order(length)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each transformed part its nearest entry, ties to the lower index, and P times their squared distance."""
    found, length = len(parts), parts.shape[1]
    sums = np.zeros((found, len(entries)), parts.dtype)
    best = np.full(found, np.iinfo(parts.dtype).max, parts.dtype)
    at = 0
    while at < length:
        for j in range(at, min(at + STEP, length)):
            apart = parts[:, j, None] - entries[None, :, j]
            sums += apart * apart
        at = min(at + STEP, length)
        if at == length:
            index = sums.argmin(1)  # the first of the least
            return index, sums[np.arange(found), index]
        whole = parts - entries[sums.argmin(1)]
        best = np.minimum(best, (whole * whole).sum(1, dtype=parts.dtype))
        left = sums <= best[:, None]
        if np.count_nonzero(left) < DENSE * left.size:
            break
    rows, of = np.nonzero(left)  # by row, then by entry; every row keeps the entry that leads
    sums = sums[rows, of]
    while at < length:
        apart = parts[rows, at : at + STEP] - entries[of, at : at + STEP]
        sums = sums + (apart * apart).sum(1, dtype=parts.dtype)
        at += STEP
        stay = sums <= best[rows]
        rows, of, sums = rows[stay], of[stay], sums[stay]
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    least = np.minimum.reduceat(sums, starts)
    hits = np.flatnonzero(sums == np.repeat(least, np.diff(np.r_[starts, len(rows)])))
    return of[hits[np.r_[True, rows[hits][1:] != rows[hits][:-1]]]], least


class Coder:
    """Assigns vectors to codebooks; small enough to travel with a task."""

    def __init__(self, books: np.ndarray, largest: int):
        """books: part x entry x position; largest: bound of any component's size."""
        length = books.shape[2]
        self.books = books
        self.padded = 1 << max(0, length - 1).bit_length()
        most = self.padded * length * (2 * largest) ** 2
        if most >= 2**63:
            raise ValueError(f"components of size {largest} make distances beyond 64 bits")
        self.kind = np.int32 if most < 2**31 else np.int64
        self.seen = [transform(b.astype(self.kind)) for b in books]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every part: two arrays of vector x part."""
        parts, _, length = self.books.shape
        index = np.empty((len(vectors), parts), np.int64)
        error = np.empty((len(vectors), parts), np.int64)
        for at in range(0, len(vectors), ROWS):
            some = slice(at, at + ROWS)
            for p in range(parts):
                cut = transform(vectors[some, p * length : (p + 1) * length].astype(self.kind))
                index[some, p], error[some, p] = nearest(cut, self.seen[p])
        return index, error // self.padded


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim)


def _learnt(rows: DataFrame, coder: Coder) -> np.ndarray:
    """The codebooks after one round: each used entry the floored mean of its parts."""
    parts, entries, length = coder.books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, entries, length), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            vectors = _matrix(batch, parts * length)
            index, _ = coder.assign(vectors)
            for p in range(parts):
                np.add.at(total[p], index[:, p], vectors[:, p * length : (p + 1) * length])
                count[p] += np.bincount(index[:, p], minlength=entries)
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()), "n": pa.array(count[part, entry], pa.int64()),
            "total": pa.array(list(total[part, entry]), pa.list_(pa.int64())),
        })

    sent = rows.select("v").mapInArrow(sums, "part int, entry int, n long, total array<long>")
    means = sent.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(length)]).alias("total")
    )
    books = coder.books.copy()
    for row in means.collect():  # at most parts x entries rows
        books[row.part, row.entry] = np.array(row.total, np.int64) // row.n
    return books


def _coded(rows: DataFrame, coder: Coder) -> DataFrame:
    """vec_id, label, code, error of every row."""
    parts, _, length = coder.books.shape

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, error = coder.assign(_matrix(batch, parts * length))
            texts = ["".join(f"{i:02x}" for i in row) for row in index.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(texts, pa.string()), pa.array(error.sum(1), pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(code, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error) of every usable vector, and the codebooks as part x entry x position.

    ``code`` holds each part's entry in hexadecimal (two digits up to 256 entries), ``error`` the squared
    distances summed over parts, ``label_error`` that sum over all rows of an equal label, NULLs together.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("x"))
    rows = rows.filter(usable(F.col("x"))).withColumn("x", F.transform("x", lambda x: x.cast("double")))
    size = rows.agg(F.max(F.size("x")), F.max(F.array_max(F.transform("x", F.abs)))).first()
    dim = -(-max(size[0] or 1, 1) // parts) * parts
    largest = int((size[1] or 0) * scale) + 1
    Coder(np.zeros((parts, 1, dim // parts), np.int64), largest)  # refuses what cannot be exact
    ints = F.transform("x", lambda x: F.floor(x * scale))
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x"))
    rows = settle(rows.select("vec_id", "label", F.concat(ints, zeros).alias("v")), "vectors")

    first = [r[0] for r in rows.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries).collect()]
    named = F.col("vec_id").isin([i for i in first if i is not None])
    chosen = named | F.col("vec_id").isNull() if None in first else named
    start = {r.vec_id: r.v for r in rows.filter(chosen).groupBy("vec_id").agg(F.min("v").alias("v")).collect()}
    whole = np.array([start[i] for i in first], np.int64).reshape(len(first), parts, dim // parts)
    books = whole.transpose(1, 0, 2).copy()
    if not first:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error")), books

    for _ in range(rounds):
        books = _learnt(rows, Coder(books, largest))
    coded = settle(_coded(rows, Coder(books, largest)), "codes")
    # One row per label; as a stored table its size is known when the join is planned.
    totals = settle(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    totals = totals.withColumnRenamed("label", "label_of")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("label_of")), "left").drop("label_of"), books


def books_sha256(books: np.ndarray) -> str:
    """Hash of all entries' decimal components, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()

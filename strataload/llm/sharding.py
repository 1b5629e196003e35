"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0 … n-1 in the order of (doc_id, size, checksum); a keyed Feistel
network permutes the numbers; shard and slot are remainder and quotient by the number of
shards. So the shuffle is reproducible from (n, shards, seed), row counts differ by one
at most whatever the data, and a row's place follows from its number without a lookup.

The network works on pairs (left, right) with left < a and right < b, where a * b >= n
and both are about sqrt(n). A number that leaves 0 … n-1 is permuted again until it is
back ("cycle walking"); fewer than a numbers lie outside, so it is back at once nearly
always and after a steps for certain.
"""

from __future__ import annotations

import math
import random
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.sources.scratch import settle

ROUNDS = 6
PRIME = (1 << 31) - 1
_SHIFT = 33


def round_keys(seed: int) -> list[tuple[int, int]]:
    """A multiplier and an offset per round."""
    draw = random.Random(seed)
    return [(draw.randrange(1, PRIME), draw.randrange(PRIME)) for _ in range(ROUNDS)]


def sides(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def _quotient(x: Column, by: int) -> Column:
    return F.call_function("div", x, F.lit(by))


def _mixed(x: Column, key: Column) -> Column:
    """A keyed function of x: an affine map and two squares modulo a prime."""
    step = (x % PRIME * key["times"] + key["plus"]) % PRIME
    step = (step * step + x) % PRIME
    return (step * step + key["plus"]) % PRIME


def _network(x: Column, n: int, seed: int, sign: int) -> Column:
    """All rounds, or with sign -1 their inverses from the last to the first.

    An even round shifts the left side by a function of the right one, an odd round the
    right side by a function of the left one.
    """
    a, b = sides(n)
    keys = [
        F.struct(F.lit(times).cast("long").alias("times"), F.lit(plus).cast("long").alias("plus"), F.lit(k % 2 == 0).alias("even"))
        for k, (times, plus) in enumerate(round_keys(seed))
    ]

    def turn(s: Column, key: Column) -> Column:
        left = F.when(key["even"], F.pmod(s["l"] + sign * _mixed(s["r"], key), F.lit(a))).otherwise(s["l"])
        right = F.when(key["even"], s["r"]).otherwise(F.pmod(s["r"] + sign * _mixed(s["l"], key), F.lit(b)))
        return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    start = F.struct(_quotient(x, b).alias("l"), (x % b).cast("long").alias("r"))
    return F.aggregate(F.array(*keys[::sign]), start, turn, lambda s: s["l"] * b + s["r"])


def _walked(x: Column, n: int, step) -> Column:
    a, b = sides(n)
    outside = a * b - n
    first = step(x)
    if not outside:
        return first
    # After outside + 1 steps a number is back for certain; beyond 64 steps the chance is below 1e-100.
    steps = F.sequence(F.lit(1), F.lit(min(outside, 64)))
    return F.aggregate(steps, first, lambda now, _: F.when(now < n, now).otherwise(step(now)))


def permuted(number: Column, n: int, seed: int) -> Column:
    """Where row ``number`` of ``n`` goes; a bijection of 0 … n-1."""
    return _walked(number.cast("long"), n, lambda x: _network(x, n, seed, 1))


def original(place: Column, n: int, seed: int) -> Column:
    """The inverse of ``permuted``: which row a place holds."""
    return _walked(place.cast("long"), n, lambda x: _network(x, n, seed, -1))


def shard_and_slot(number: Column, n: int, shards: int, seed: int) -> dict[str, Column]:
    place = permuted(number, n, seed)
    return {"shard": (place % shards).cast("int"), "slot": _quotient(place, shards)}


def number_rows(rows: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """Rows with ``name`` = 0 … n-1 in the given order, and n.

    Equal rows are interchangeable; a random last key lets a range boundary fall between
    them. Only a count per range reaches the driver.
    """
    keys = [F.col(c).asc_nulls_first() for c in order] + [F.col("_tie")]
    slots = settle(
        rows.withColumn("_tie", F.rand(1)).repartitionByRange(*keys).sortWithinPartitions(*keys)
        .drop("_tie").withColumn("_slot", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_slot", _SHIFT)
    counts = sorted(slots.groupBy(part.alias("part")).count().collect())
    below = [0, *accumulate(n for _, n in counts)]
    offsets = rows.sparkSession.createDataFrame(
        [(p, n) for (p, _), n in zip(counts, below)], "_part long, _below long"
    )
    # A row per range: the count of tasks bounds it.
    found = slots.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    within = F.col("_slot").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    return found.withColumn(name, F.col("_below") + within).drop("_part", "_below", "_slot"), below[-1]


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 20240229) -> DataFrame:
    """Each row's number, shard and slot, by the law ``rows``.

    A NULL or empty text has checksum 0 and size 8; NULL ids come first; repeated rows get
    places of their own; an empty table gives no rows. Other columns are not read.
    """
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32")
    )
    numbered, n = number_rows(rows, ["doc_id", "size", "text_crc32"], "row_number")
    return numbered.withColumns({
        "law": F.lit("rows"), **shard_and_slot(F.col("row_number"), n, shards, seed),
        "grown_shard": F.lit(None).cast("int"),
    })

"""Finding the keys that hold too many rows for one task, and cutting them along an order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataload.sources.scratch import settle

PIECE = "_piece"
_HOT, IS_HOT = "_hot", "_is_hot"
# Rows of hot keys that one task sorts and numbers, however small the pieces are.
_ROWS_PER_TASK = 1_000_000


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as hot: above ``rows_per_group`` rows, whatever the size of the data.

    ``versions_per_probe`` bounds the versions that one fact row is compared with, and
    ``broadcast_keys`` the entities of a load whose list is broadcast.
    """

    rows_per_group: int = 2_000_000
    versions_per_probe: int = 512
    broadcast_keys: int = 500_000


@dataclass(frozen=True)
class KeyProfile:
    keys: int
    rows: int
    largest: int


@dataclass(frozen=True)
class Cuts:
    """The hot keys, one row each in shared storage, the number of all their rows, and the rows of a piece."""

    hot: DataFrame
    rows: int
    rows_per_piece: int


def profile(df: DataFrame, key: str) -> KeyProfile:
    """Number of keys, of rows, and rows of the largest key, NULL being one: one row reaches the driver."""
    row = (
        df.groupBy(key).agg(F.count("*").alias("n"))
        .agg(F.count("*").alias("keys"), F.sum("n").alias("rows"), F.max("n").alias("largest"))
        .first()
    )
    return KeyProfile(row["keys"], row["rows"] or 0, row["largest"] or 0)


def hot_keys(df: DataFrame, key: str, above: int) -> DataFrame:
    """Keys of more than ``above`` rows, and their number of rows; a NULL key is one too."""
    counts = df.groupBy(F.col(key).alias(_HOT)).agg(F.count("*").alias("n")).where(F.col("n") > above)
    return settle(counts.withColumn(IS_HOT, F.lit(True)), "hot-keys")


def marked(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``df`` with ``_is_hot``: true for rows of a hot key, else NULL."""
    return df.join(hot.select(_HOT, IS_HOT), F.col(key).eqNullSafe(F.col(_HOT)), "left").drop(_HOT)


def find_cuts(df: DataFrame, key: str, found: KeyProfile, policy: SkewPolicy) -> Cuts | None:
    """The hot keys of ``df``, or None; nothing but the number of their rows reaches the driver."""
    if found.largest <= policy.rows_per_group:
        return None
    hot = hot_keys(df, key, policy.rows_per_group)
    rows = hot.agg(F.sum("n")).first()[0]
    return Cuts(hot, rows, policy.rows_per_group)


def with_piece(df: DataFrame, key: str, order: tuple[str, ...], cuts: Cuts) -> DataFrame:
    """Number the pieces of hot keys in the order of ``order``; NULL for all other keys.

    The rows of hot keys are range-partitioned by key and the first of ``order``, sorted, and every
    ``rows_per_piece`` of a partition make a piece. A task deals with very many pieces, so
    tasks, and what each sends to the driver, follow the cores and the rows, not the pieces. NULLs go
    last. The numbers hold for one run of the plan; settle the rows.
    """
    rows = marked(df, key, cuts.hot)
    most = max(df.sparkSession.sparkContext.defaultParallelism, -(-cuts.rows // _ROWS_PER_TASK))
    tasks = min(-(-cuts.rows // cuts.rows_per_piece) + 1, most)
    line = [F.col(c).asc_nulls_last() for c in order]
    dealt = rows.where(IS_HOT).repartitionByRange(tasks, F.col(key), line[0]).sortWithinPartitions(key, *line)
    # The partition in the upper bits, the place in it in the lower 33.
    place, places = F.monotonically_increasing_id(), F.lit(1 << 33)
    numbered = dealt.withColumn(PIECE, place).withColumn(
        PIECE, F.col(PIECE) - F.pmod(F.pmod(PIECE, places), F.lit(cuts.rows_per_piece).cast("long"))
    )
    others = rows.where(F.col(IS_HOT).isNull()).withColumn(PIECE, F.lit(None).cast("long"))
    return numbered.unionByName(others).drop(IS_HOT)

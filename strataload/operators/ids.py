"""Dense integer keys after a high-water mark."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.sources.scratch import settle

_SLOT = "_slot"
_ROWS_BELOW = "_rows_below"
# monotonically_increasing_id() holds the partition number above its lower 33 bits.
_SHIFT = 33


def allocate_ids(df: DataFrame, id_col: str, order: list[str], start: int | Column = 0) -> DataFrame:
    """Add ``id_col`` = start + 1, start + 2, … in the order of ``order``.

    ``order`` must tell all rows apart. Rows are range-partitioned and numbered
    inside their partition; the only thing collected is one count per partition,
    from which each partition's offset follows. So no task sees more than its own
    range, however many keys there are. The numbered rows are settled first: the
    ranges come from a sample, and the counts and the rows must share them.
    """
    spark = df.sparkSession
    columns = [F.col(c).asc_nulls_last() for c in order]
    slots = settle(
        df.repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn(_SLOT, F.monotonically_increasing_id()),
        "ids",
    )
    part = F.shiftright(_SLOT, _SHIFT)
    counts = slots.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    below = [0, *accumulate(row["n"] for row in counts)][:-1]
    offsets = spark.createDataFrame(
        [(row["part"], n) for row, n in zip(counts, below)], "part long, _rows_below long"
    )
    position = F.col(_SLOT).bitwiseAND(F.lit((1 << _SHIFT) - 1))
    start = F.lit(start) if isinstance(start, int) else start
    # One row per partition, so the offsets are always small enough to broadcast.
    return (
        slots.withColumn("part", part)
        .join(F.broadcast(offsets), "part")
        .withColumn(id_col, (start + F.col(_ROWS_BELOW) + position + 1).cast("long"))
        .drop("part", _SLOT, _ROWS_BELOW)
    )


def highest_id(table: DataFrame, id_col: str) -> Column:
    """Largest key in use, 0 for an empty table (L20), as a scalar subquery."""
    return table.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar()

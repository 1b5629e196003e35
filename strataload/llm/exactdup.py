"""Exact dedup by skew-safe combining.

Rows with equal texts are first combined inside each task, then per (text, salt), and
the few salt winners of a text are combined at last. Each of the three steps groups by
the digest *and* the whole normalised text, so two texts that share a digest stay apart.
A text that a third of all rows repeat reaches a final task as ``salts`` rows at most.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataload.sources.scratch import settle

_ID, _NORM, _DIGEST, _KEY = "_x_id", "_x_norm", "_x_digest", "_x_key"
BROADCAST_KEYS = 2_000_000


def normalised(text: Column) -> Column:
    """A-Z in lower case, nothing else; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def sha256(norm: Column) -> Column:
    return F.sha2(norm.cast("binary"), 256)


def text_classes(docs: DataFrame, salts: int = 64, digest=sha256) -> DataFrame:
    """One stored row per distinct text: digest, keep_id, group_size, norm.

    ``norm`` holds the text only where another text has the same digest; else it is
    NULL, and the digest alone names the class.
    """
    rows = docs.select(F.col("doc_id").alias(_ID), normalised(F.col("text")).alias(_NORM))
    rows = rows.select(_ID, _NORM, digest(F.col(_NORM)).alias(_DIGEST))
    # The partial aggregate of this exchange is the local step; it never ships a text twice from one task.
    salted = rows.groupBy(_DIGEST, _NORM, F.pmod(F.xxhash64(_ID), F.lit(salts)).alias("_x_salt")).agg(
        F.max(_ID).alias("keep_id"), F.count("*").alias("n")
    )
    # Dealt by digest alone, the winners need no further exchange to be combined and to find shared digests.
    merged = (
        salted.repartition(_DIGEST)
        .groupBy(_DIGEST, _NORM)
        .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    )
    texts = F.count("*").over(Window.partitionBy(_DIGEST))
    classes = merged.select(_DIGEST, "keep_id", "group_size", F.when(texts > 1, F.col(_NORM)).alias(_NORM))
    return settle(classes, "text-classes")


def exact_groups(docs: DataFrame, salts: int = 64, digest=sha256) -> DataFrame:
    """For every row: doc_id, keep_id, group_size, kept, digest.

    Of equal texts the largest doc_id stays. A NULL doc_id ranks below all others, NULL
    text equals empty text, and rows that repeat the same doc_id and text are all marked
    as kept (``exact_dedup`` leaves one of them). An empty table gives no rows.
    """
    classes = text_classes(docs, salts, digest)
    rows = docs.select(F.col("doc_id").alias(_ID), normalised(F.col("text")).alias(_NORM))
    rows = rows.withColumn(_DIGEST, digest(F.col(_NORM)))
    shared = classes.filter(F.col(_NORM).isNotNull())
    found = rows.select(_ID, _DIGEST).join(classes.filter(F.col(_NORM).isNull()).drop(_NORM), _DIGEST)
    if not shared.isEmpty():  # texts that share a digest find their class by content
        found = found.unionByName(rows.join(shared, [_DIGEST, _NORM]).drop(_NORM))
    return found.select(
        F.col(_ID).alias("doc_id"), "keep_id", "group_size",
        F.col(_ID).eqNullSafe(F.col("keep_id")).alias("kept"), F.col(_DIGEST).alias("digest"),
    )


def exact_dedup(docs: DataFrame, salts: int = 64, digest=sha256) -> DataFrame:
    """The rows that stay, one per distinct text, with all their columns.

    A row that no other shares its text's 64-bit hash with stays as it is, without a shuffle while the shared hashes
    are few enough to broadcast (counted first); beyond that its text travels once, to be told apart.
    The others are combined as whole rows, inside each task, per (text, salt) and per text, by full contents
    each time. Of equal texts the largest doc_id stays, NULL ranking lowest, and among rows that
    repeat it the one whose columns hash highest.
    """
    named = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    row = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(named)])
    field = lambda name: F.col(f"_x_row.c{docs.columns.index(name)}")
    key = F.xxhash64(normalised(F.col("text"))).alias(_KEY)
    held = docs.select(key, row.alias("_x_row"))
    shared = settle(docs.select(key).groupBy(_KEY).agg(F.count("*").alias("n")).filter("n > 1").select(_KEY), "shared-keys")
    if shared.count() <= BROADCAST_KEYS:  # of 8 bytes each
        shared = F.broadcast(shared)
    alone = held.join(shared, _KEY, "left_anti").select("_x_row")
    doc_id, norm = field("doc_id"), normalised(field("text"))
    rank = F.struct(doc_id.isNotNull().alias("known"), doc_id.alias("id"), F.xxhash64("_x_row").alias("hash"))
    met = held.join(shared, _KEY, "left_semi").withColumns({_NORM: norm, _DIGEST: digest(norm), "_x_rank": rank})
    best = [F.max_by("_x_row", "_x_rank").alias("_x_row"), F.max("_x_rank").alias("_x_rank")]
    salted = met.groupBy(_DIGEST, _NORM, F.pmod(F.xxhash64("_x_rank"), F.lit(salts)).alias("_x_salt")).agg(*best)
    winners = salted.groupBy(_DIGEST, _NORM).agg(*best).select("_x_row")
    return alone.unionByName(winners).select(*[F.col(f"_x_row.c{i}").alias(c) for i, c in enumerate(docs.columns)])

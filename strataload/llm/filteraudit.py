"""Filter interaction audit: what every order of applying filters would remove, at each step.

A document is known by its mask, the set of filters it fails. Under an order, it is removed
at the first step whose filter is in the mask. All orders that begin with the same letters
are neighbours when orders are ranked lexicographically (the Lehmer rank): a prefix of s of
n letters covers one interval of (n - s)! ranks. So for a mask, the ranks at which step s
removes it are the intervals of the prefixes whose last letter is the first one in the mask.
Each mask's count is added where an interval begins and taken off where it ends (a
difference array per step), and one running sum over the n! ranks gives every total.

The work on documents is one aggregate to (part, mask); everything after it has at most
2**n rows per part in and n! * n rows per part out, and stays spread over parts.

Defined cases: a NULL or empty table part, a NULL part (an empty string) and NULL failure
flags (not failing) all count; a part has rows for all orders and steps, zeros included.
No documents give no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataload.sources.scratch import settle

MEASURES = ("removed", "redundant", "good_lost", "toxic_lost")
SPACES = r"[\x20\x09-\x0D]+"


def mask_intervals(letters: str) -> list[tuple[int, int, int, int, bool]]:
    """(mask, step, first rank, rank after the last, removed before) wherever step's filter is in the mask.

    One row per mask and prefix of an order whose last letter the mask holds; about 5,200 for five filters.
    """
    n = len(letters)
    ranked = list(permutations(range(n)))  # in lexicographic order
    out = []
    for step in range(1, n + 1):
        width = factorial(n - step)
        for start in range(0, factorial(n), width):
            *before, last = ranked[start][:step]
            for mask in range(1 << n):
                if mask >> last & 1:
                    out.append((mask, step, start, start + width, any(mask >> b & 1 for b in before)))
    return out


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of a text: few words, few distinct words, many capitals, a character of ``#$%&*|``."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, SPACES), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
        "C": 100 * capitals > 3 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def document_masks(docs: DataFrame, labels: DataFrame, fails: dict[str, Column]) -> DataFrame:
    """(part, mask, n, good, toxic) of documents, the last bit being "a smaller doc_id has this very text".

    ``fails`` gives the other bits, in order; they may depend on the text alone or on any column. Texts leave
    their task as SHA-256 hashes. Equal texts are combined per doc_id first and per (text, part, flags) next, so a
    text that a third of all rows repeat meets as few rows as it has parts and flags. A NULL doc_id is
    neither smaller nor larger than another; a document with several labels has each of them.
    """
    bits = [F.when(F.coalesce(fail, F.lit(False)), 1 << i).otherwise(0) for i, fail in enumerate(fails.values())]
    thin = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), sum(bits[1:], bits[0]).alias("mask"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest"),
    )
    rows = thin.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    rows = rows.join(marks, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    known = F.col("doc_id").isNotNull()
    groups = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("unknown"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"),
    )
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    groups = groups.withColumn("own", F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0))
    repeats = F.col("n") - F.col("unknown") - F.col("own")
    split = F.explode(F.array(
        F.struct(F.col("mask"), (F.col("n") - repeats).alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(1 << len(fails))).alias("mask"), repeats.alias("n")),
    ))
    each = groups.select("part", "good", "toxic", split.alias("x")).select("part", "good", "toxic", "x.mask", "x.n")
    marked = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return each.groupBy("part", "mask").agg(F.sum("n").alias("n"), marked("good"), marked("toxic"))


def audit(masks: DataFrame, letters: str) -> DataFrame:
    """part, filter_order, step and the counts of every order and step, from (part, mask, n, good, toxic).

    ``masks`` has any number of rows per part and mask; ``good`` and ``toxic`` are counts like ``n``.
    """
    spark, n = masks.sparkSession, len(letters)
    counted = masks.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    counted = settle(counted, "masks")
    intervals = spark.createDataFrame(mask_intervals(letters), "mask int, step int, start int, stop int, early boolean")
    hit = counted.join(F.broadcast(intervals), "mask").select(
        "part", "step", "start", "stop",
        F.when(F.col("early"), 0).otherwise(F.col("n")).alias("removed"), F.when(F.col("early"), F.col("n")).otherwise(0).alias("redundant"),
        F.when(F.col("early"), 0).otherwise(F.col("good")).alias("good_lost"), F.when(F.col("early"), 0).otherwise(F.col("toxic")).alias("toxic_lost"),
    )
    # Difference arrays: a count enters where its interval begins and leaves where it ends.
    ends = F.explode(F.array(F.struct(F.col("start").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("stop").alias("rank"), F.lit(-1).alias("sign"))))
    edges = hit.withColumn("end", ends).select("part", "step", "end.rank", *[(F.col(m) * F.col("end.sign")).alias(m) for m in MEASURES])
    # A zero at every rank, so that the running sum has a row there.
    ranks = counted.select("part").distinct().withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    ranks = ranks.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(factorial(n) - 1))))
    edges = edges.unionByName(ranks.select("*", *[F.lit(0).cast("long").alias(m) for m in MEASURES]))
    edges = edges.groupBy("part", "step", "rank").agg(*[F.sum(m).alias(m) for m in MEASURES]).filter(F.col("rank") < factorial(n))
    running = Window.partitionBy("part", "step").orderBy("rank")  # n! rows
    totals = edges.select("part", "step", "rank", *[F.sum(m).over(running).alias(m) for m in MEASURES])
    # Names of the orders and each part's figures that no order changes.
    orders = spark.createDataFrame([(r, "".join(p)) for r, p in enumerate(permutations(letters))], "rank int, filter_order string")
    only = lambda i: F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0))
    whole = counted.groupBy("part").agg(F.sum("n").alias("documents"), F.array(*[only(i) for i in range(n)]).alias("alone"))
    rows = totals.join(F.broadcast(orders), "rank").withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
    rows = rows.join(whole, "part")
    so_far = Window.partitionBy("part", "rank").orderBy("step")
    each = Window.partitionBy("part", "letter")  # n! rows, each order once
    return rows.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        (F.col("documents") - F.sum("removed").over(so_far)).alias("kept"), "removed", "redundant",
        F.col("alone")[F.instr(F.lit(letters), F.col("letter")) - 1].alias("unique_fails"),
        "good_lost", "toxic_lost", F.sum("removed").over(each).alias("shapley"),
    )

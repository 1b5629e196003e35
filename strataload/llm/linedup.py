"""Line dedup by a suffix array over line ids.

Every line gets an id; suffixes of the line sequences are ranked by their first 1, 2,
4, … lines, each round by the pair of ranks at a place and as far behind it as the
ranks reach ("prefix doubling"). Ranks are dense numbers in sorted order, given to
distinct classes only; a suffix whose prefix occurs once leaves, as no longer prefix of
it can repeat. Rounds go on until every suffix is unique or has run to its text's end,
so their number is the logarithm of the longest repeated run, and all but the first
touch repeated lines only.

A class is an interval of the suffix array in which neighbours share at least so many lines
(a longest-common-prefix interval); each member but the first begins a later copy of the
interval's first member. Later copies that begin one line apart, of first members one line
apart, are one run, and runs that lie within others are dropped: the maximal repeated
runs are left, each with the place it repeats. A run counts if it has ``min_lines`` lines, or is one line of
``min_words`` words.

Built-in functions only. A class, however frequent, is counted on the map side and met
by an equi-join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataload.llm.sharding import number_rows
from strataload.sources.scratch import discard, settle

WORD = r"[^\x20\x09-\x0D]+"
_DOC = ["_id", "_hash"]  # the text's hash tells apart rows that share an id


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))


def _ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs more than once, with the key's dense rank and its first place."""
    place = F.struct(*_DOC, "pos")
    classes = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1").drop("n")
    classes, _ = number_rows(classes, keys, "rank_")
    return rows.join(classes, keys).drop(*keys).withColumnRenamed("rank_", "rank")


def _runs(rows: DataFrame, reach: int) -> DataFrame:
    """Runs (_id, _hash, pos, end, first) of neighbouring later copies, of ``reach`` lines each, whose first copies are neighbours too."""
    later = rows.filter(~F.struct(*_DOC, "pos").eqNullSafe(F.col("first"))).select(*_DOC, "pos", "first").distinct()
    later = later.withColumns({"f_id": F.col("first._id"), "f_hash": F.col("first._hash"), "shift": F.col("pos") - F.col("first.pos")})
    line = [*_DOC, "f_id", "f_hash", "shift"]
    later = later.withColumn("island", F.col("pos") - F.row_number().over(Window.partitionBy(*line).orderBy("pos")))
    runs = later.groupBy(*line, "island").agg(F.min("pos").alias("start"), (F.max("pos") + reach - 1).alias("end"), F.min("first").alias("first"))
    return settle(runs.select(*_DOC, F.col("start").alias("pos"), "end", "first"), "line-runs")


def repeated_runs(docs: DataFrame, min_lines: int, min_words: int | None = None) -> DataFrame:
    """(_id, _hash, pos, end, first): the maximal runs of lines that repeat an earlier place.

    A run has at least ``min_lines`` lines, or is a line of ``min_words`` words. Lines
    ``pos`` to ``end`` equal as many lines from ``first`` (_id, _hash, pos) on, which comes before
    by (_id, _hash, pos). No run lies within another one of its text; where a run's parts
    have their first copies at different places, it is told as several that overlap.
    """
    lines = _keyed(docs).select(*_DOC, F.posexplode(F.split("_text", "\n")).alias("pos", "line"))
    words = F.size(F.regexp_extract_all("line", F.lit(WORD), F.lit(0)))
    alone = F.lit(False) if min_words is None else words >= min_words
    lines = lines.select(*_DOC, "pos", F.unhex(F.md5("line")).alias("line"), alone.alias("alone"))
    rows = settle(_ranked(lines, ["line"]), "line-ranks")
    runs = _runs(rows if min_lines == 1 else rows.filter("alone"), 1)
    reach = 1
    while not rows.isEmpty():
        step = min(reach, min_lines - reach) if reach < min_lines else reach  # ranks of exactly min_lines are needed; there both may overlap
        behind = Window.partitionBy(*_DOC).orderBy("pos").rangeBetween(step, step)
        pairs = rows.select(*_DOC, "pos", "rank", F.max("rank").over(behind).alias("behind")).filter("behind is not null")
        before, rows = rows, settle(_ranked(pairs, ["rank", "behind"]), "line-ranks")
        discard(before)
        reach += step
        if reach >= min_lines:
            runs = runs.unionByName(_runs(rows, reach))
    order = Window.partitionBy(*_DOC).orderBy("pos", F.desc("end"), "first").rowsBetween(Window.unboundedPreceding, -1)
    return runs.withColumn("reached", F.max("end").over(order)).filter("reached is null or reached < end").drop("reached")


def line_dedup(docs: DataFrame, min_lines: int = 2, min_words: int | None = None) -> DataFrame:
    """doc_id, n_lines, n_deleted and the remaining text of every row.

    A line goes if it lies in a run of at least ``min_lines`` lines of which an earlier
    copy exists, earlier by (doc_id, place); with ``min_words``, also a line of that many words
    of which an earlier copy exists, whatever stands around it. Copies inside one text count, also when they
    overlap. Texts of any length are taken whole; only repeated lines go beyond the first
    round. NULL text is one empty line, empty lines are lines like others, a NULL doc_id
    comes before all others; rows with equal doc_id and text are one document and share
    the result; an empty table gives no rows. Other columns are not read.
    """
    runs = repeated_runs(docs, min_lines, min_words)
    gone = runs.select(*_DOC, F.explode(F.sequence("pos", "end")).alias("pos")).distinct()
    gone = gone.groupBy(*_DOC).agg(F.array_sort(F.collect_list("pos")).alias("gone"))
    rows = _keyed(docs)
    same = rows["_id"].eqNullSafe(gone["_id"]) & (rows["_hash"] == gone["_hash"])
    rows = rows.join(gone, same, "left").select(
        rows["_id"].alias("doc_id"), "_text", F.coalesce("gone", F.array().cast("array<int>")).alias("gone"), F.split("_text", "\n").alias("lines")
    )
    n = F.size("lines")
    # Between two deleted places lies a slice that stays.
    edges = F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(n))
    kept = F.flatten(F.transform(
        F.sequence(F.lit(1), F.size(edges) - 1),
        lambda i: F.slice(F.col("lines"), F.get(edges, i - 1) + 2, F.get(edges, i) - F.get(edges, i - 1) - 1),
    ))
    text = F.when(F.size("gone") == 0, F.col("_text")).otherwise(F.array_join(kept, "\n"))
    return rows.select("doc_id", n.cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_deleted"), text.alias("text"))

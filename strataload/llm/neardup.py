"""MinHash near-dedup as a chosen-path set similarity join.

A document is its set of distinct word shingles; documents with equal sets form a class
first. Each class has 64 minwise values. In each of several independent trees, a node's
classes branch by the values at some of the 64 places, two at the root of each tree and then one or, every third time, two:
4/3 in expectation, so that pairs below 0.75 meet ever less often from level to level while pairs
above it do not. Classes that agree on a value meet in the same child. A node with few pairs of classes that are
not yet connected compares all of these. Another one compares all with a few of its classes and branches
on without these, unless the rest is connected by then: a large group of near copies is so
joined in work linear in its size, and the few classes beside it are soon used up.

Two sets of similarity 0.75 miss each other at all 16 root places with a chance of 2e-10. A pair that is
together at the root and never compared with a pivot is still together after k levels by the odds of
a branching process of mean one: over all trees it is lost with a chance of 7e-7, 3e-5, 4e-4 and 6e-3 for
k = 1, 2, 4 and 8 at exactly 0.75, and of 2e-8, 8e-7, 2e-5 and 5e-4 at 0.8.

A node's pivots, or the few classes outside the main label of a small node, travel to each of its classes as one list, so
no row is made for a pair before it is likely: pairs that meet are compared there by two bits each of 256 minwise values, then confirmed on the
shingles of both whole texts. Only links between different sets are looked for, and only
between classes not yet connected, so no group is expanded into all of its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.llm.components import components
from strataload.sources.scratch import discard, settle, small_batches

PLACES = 64
MORE = 192  # further minwise values, for sketches alone
BROADCAST_REPS = 200_000
BROADCAST_GONE = 1_000_000
_draw = np.random.default_rng(20240229)
_BYTE = _draw.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_TIMES = _draw.integers(0, 2**63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _draw.integers(0, 2**64, PLACES, dtype=np.uint64)
_TIMES_MORE = _draw.integers(0, 2**31, MORE, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS_MORE = _draw.integers(0, 2**32, MORE, dtype=np.uint32)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case; bytes.split() parts at 0x20 and 0x09-0x0D only."""
    return (text or "").encode("utf-8", "replace").translate(_LOWER).split()


def shingles(text: str | None, width: int = 5) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(width)]))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """64-bit hashes of all shingles of a text at once, by prefix sums over its bytes."""

    def __init__(self):
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, size: int) -> None:
        if len(self.powers) < size:
            size = 1 << size.bit_length()
            ones = np.ones(1, np.uint64)
            self.powers = np.concatenate([ones, np.full(size, _BASE)]).cumprod(dtype=np.uint64)
            self.inverses = np.concatenate([ones, np.full(size, _INVERSE)]).cumprod(dtype=np.uint64)

    def shingles(self, text: str | None, width: int) -> np.ndarray:
        """The distinct hashes, sorted."""
        data = np.frombuffer((text or "").encode("utf-8", "replace").translate(_LOWER), np.uint8)
        turns = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[data], [True]])))
        starts, ends = turns[::2], turns[1::2]
        if not len(starts):
            return np.zeros(0, np.uint64)
        self._reach(len(data) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), (_BYTE[data] * self.powers[: len(data)]).cumsum(dtype=np.uint64)])
        words = _mixed((sums[ends] - sums[starts]) * self.inverses[starts])
        width = min(width, len(words))
        total = np.full(len(words) - width + 1, width, np.uint64)
        for k in range(width):
            total = _mixed(total + words[k : len(words) - width + 1 + k])
        return np.unique(total)


def minwise(hashes: np.ndarray) -> np.ndarray:
    out = np.full(PLACES, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 1024):
        out = np.minimum(out, (hashes[at : at + 1024, None] * _TIMES + _PLUS).min(0))
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def sketch(values: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Two bits of each of 256 minwise values, 32 values to a long: the given ones and 192 of half as many bits."""
    more, short = np.full(MORE, 2**32 - 1, np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 256):
        more = np.minimum(more, (short[at : at + 256, None] * _TIMES_MORE + _PLUS_MORE).min(0))
    twos = np.concatenate([values & 3, (more >> np.uint32(10) & np.uint32(3)).view(np.int32)]).astype(np.uint8).reshape(-1, 4)
    return (twos << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8).view("<i8")


def sets_of(docs: DataFrame, width: int = 5) -> DataFrame:
    """Per row: doc_id, _hash of the text, n (size of its set), id (digest of the set), its minwise values and their sketch."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for batch in batches:
            ids, sizes, values, sketches = [], [], [], []
            for text in batch["_text"]:
                found = hasher.shingles(text, width)
                sizes.append(len(found))
                ids.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                values.append(minwise(found) if len(found) else None)
                sketches.append(sketch(values[-1], found) if len(found) else None)
            out = pd.DataFrame({"_hash": batch["_hash"], "n": sizes, "id": ids, "values": values, "sketch": sketches})
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            yield out

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))
    with small_batches(docs.sparkSession):
        return settle(rows.mapInPandas(measure, "doc_id long, _hash long, n long, id binary, values array<int>, sketch array<long>"), "shingle-sets")


def agreeing(a: Column, b: Column) -> Column:
    """The number of minwise values whose two bits two sketches share."""
    apart = F.lit(0)
    for k in range((PLACES + MORE) // 32):
        bits = a[k].bitwiseXOR(b[k])
        apart = apart + F.bit_count(bits.bitwiseOR(F.shiftrightunsigned(bits, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return F.lit(PLACES + MORE) - apart


def confirmer(width: int, percent: int):
    @F.pandas_udf(T.BooleanType())
    def confirmed(a: pd.Series, b: pd.Series) -> pd.Series:
        out, last, left = [], None, None
        for x, y in zip(a, b):
            if x != last:  # a star's centre comes many times in a row
                last, left = x, shingles(x, width)
            x, y = left, shingles(y, width)
            both = len(x & y)
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out)

    return confirmed


class Join:
    """The state of one similarity join: classes, their texts, and the labels found so far."""

    def __init__(self, docs: DataFrame, rows: DataFrame, width: int, percent: int, trees: int, node_size: int, pivots: int, levels: int):
        self.docs, self.percent, self.trees, self.node_size, self.pivots, self.levels = docs, percent, trees, node_size, pivots, levels
        self.confirmed = confirmer(width, percent)
        # Values match at percent/100 of the places and their two bits at a quarter of the others; less four standard deviations.
        share, places = percent / 100 * 0.75 + 0.25, PLACES + MORE
        self.least = int(places * share - 4 * (places * share * (1 - share)) ** 0.5)
        classes = rows.filter("n > 0").groupBy("id").agg(
            F.min(F.struct("doc_id", "_hash")).alias("rep"), F.first("n").alias("n"), F.first("values").alias("values"), F.first("sketch").alias("sketch")
        )
        self.classes = settle(classes, "classes")
        self.labels: DataFrame | None = None
        self.tried: DataFrame | None = None
        self.pending: list[DataFrame] = []

    def branch(self, rows: DataFrame, level: int) -> DataFrame:
        """Children of (node, tree, path, values, id): one or two for each, by the values at places that the path draws."""

        def child(k: int):
            place = (
                F.col("tree") * 2 + k if level == 0 else F.pmod(F.xxhash64("tree", "path", F.lit(k)), F.lit(PLACES)).cast("int")
            )
            value = F.element_at("values", (place + 1).cast("int"))
            return F.struct(F.xxhash64("node", place, value).alias("node"), F.xxhash64("path", F.lit(k)).alias("path"))

        both, one = F.array(child(0), child(1)), F.array(child(0))
        two = F.pmod(F.xxhash64("tree", "path", F.lit(2)), F.lit(3)) == 0
        rows = rows.withColumn("child", F.explode(both if level == 0 else F.when(two, both).otherwise(one)))
        return rows.select(F.col("child.node").alias("node"), "tree", F.col("child.path").alias("path"), "id")

    def labelled(self, rows: DataFrame) -> DataFrame:
        if self.labels is None:
            return rows.withColumn("label", F.col("id"))
        labels = self.labels.withColumnRenamed("node", "id")
        return rows.join(labels, "id", "left").withColumn("label", F.coalesce("root", "id")).drop("root")

    def meeting(self, rows: DataFrame) -> DataFrame:
        """Rows of the nodes that hold classes not yet connected, with what is known of the node.

        main: its most frequent label. small: it holds few pairs of different labels for
        its size, as many as ``node_size`` classes that are all apart.
        """
        parts = rows.groupBy("node", "label").agg(F.count("*").cast("double").alias("n"))
        size, pairs = F.sum("n"), (F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2
        nodes = parts.groupBy("node").agg(
            (pairs <= self.node_size / 2 * size).alias("small"),
            F.max(F.struct("n", "label"))["label"].alias("main"), F.count("*").alias("labels"),
        ).filter("labels > 1").drop("labels")
        sketches = self.classes.select("id", F.col("n").alias("size"), "sketch")
        return settle(rows.join(nodes, "node").join(sketches, "id"), "nodes")

    def partners(self, rows: DataFrame, large: Column) -> DataFrame:
        """Per node the classes that all its others are held against, a bounded list: in a small node all outside
        the main label, in a large one the smallest of each part of these by hash."""
        outside = F.col("label") != F.col("main")
        one = F.struct("id", "label", "size", "sketch")
        slot = F.pmod(F.xxhash64("id"), F.lit(self.pivots))
        pivots = [F.min(F.when(outside & large & (slot == k), one)).alias(f"p{k}") for k in range(self.pivots)]
        met = rows.filter(outside).groupBy("node").agg(F.collect_list(F.when(~large, one)).alias("few"), *pivots)
        return met.select("node", F.concat("few", F.filter(F.array(*[f"p{k}" for k in range(self.pivots)]), lambda p: p.isNotNull())).alias("partners"))

    def likely(self, size_a: Column, sketch_a: Column, size_b: Column, sketch_b: Column) -> Column:
        sizes = 100 * F.least(size_a, size_b) >= self.percent * F.greatest(size_a, size_b)
        return sizes & (agreeing(sketch_a, sketch_b) >= self.least)

    def near(self, met: DataFrame) -> DataFrame:
        """Pairs (a, b) of class ids in ``met``, rows with their node's partners, that sizes and sketches allow."""
        fits = F.filter("partners", lambda p: (p["label"] != F.col("label")) & self.likely(F.col("size"), F.col("sketch"), p["size"], p["sketch"]))
        pairs = met.select("id", F.explode(F.transform(fits, lambda p: p["id"])).alias("other"))
        return pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))

    def near_all(self, rows: DataFrame) -> DataFrame:
        """As ``near``, for all pairs of the nodes of ``rows``."""
        two = rows.select("node", *[F.col(c).alias(f"{c}_b") for c in ("id", "label", "size", "sketch")])
        pairs = rows.filter("label <> main").join(two, "node").filter("label <> label_b")
        pairs = pairs.filter(self.likely(F.col("size"), F.col("sketch"), F.col("size_b"), F.col("sketch_b")))
        return pairs.select(F.least("id", "id_b").alias("a"), F.greatest("id", "id_b").alias("b"))

    def link(self, pairs: DataFrame) -> None:
        """Confirm likely pairs (a, b) of class ids; those that hold are kept until ``connect``."""
        near = pairs.withColumn("new", F.lit(True))
        if self.tried is not None:  # a pair that met before, in another node, has its answer
            near = near.unionByName(self.tried.withColumn("new", F.lit(False)))
        near = settle(near.groupBy("a", "b").agg(F.min("new").alias("new")).filter("new").select("a", "b"), "near")
        self.tried = near if self.tried is None else self.tried.unionByName(near)
        count = near.count()
        if not count:
            return
        few = F.broadcast if count <= BROADCAST_REPS else lambda x: x  # pairs of a few bytes each
        needed = near.select(F.explode(F.array("a", "b")).alias("id"))
        reps = self.classes.select("id", F.col("rep.doc_id").alias("_r"), F.col("rep._hash").alias("_h")).join(few(needed), "id", "left_semi")
        text = F.coalesce(F.col("text"), F.lit(""))
        found = self.docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("_hash"), text.alias("text"))
        if reps.count() <= BROADCAST_REPS:  # of a few bytes each
            reps = F.broadcast(reps)
        texts = reps.join(found, F.col("_r").eqNullSafe(F.col("doc_id")) & (F.col("_h") == F.col("_hash"))).select("id", "text")
        texts = settle(texts, "texts")
        sides = [texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab"]
        both = sides[0].join(few(near), "a").join(sides[1], "b")
        with small_batches(self.docs.sparkSession):
            links = settle(both.filter(self.confirmed("text_a", "text_b")).select("a", "b"), "links")
        discard(texts)
        if not links.isEmpty():
            self.pending.append(links)

    def connect(self) -> None:
        """Labels from all links so far."""
        if not self.pending:
            return
        links = self.pending[0]
        for more in self.pending[1:]:
            links = links.unionByName(more)
        if self.labels is not None:
            links = links.unionByName(self.labels.select(F.col("node").alias("a"), F.col("root").alias("b")))
        self.labels = components(links, "a", "b")
        discard(*self.pending)
        self.pending = []

    def run(self) -> DataFrame | None:
        """(node, root) for the classes that are linked; None if none is."""
        tree = F.explode(F.sequence(F.lit(0), F.lit(self.trees - 1))).alias("tree")
        roots = self.classes.select("id", "values", tree).withColumns({"path": F.lit(1).cast("long"), "node": F.col("tree").cast("long")})
        rows, before = self.branch(roots, 0), None
        for level in range(1, self.levels + 1):
            rows = self.meeting(self.labelled(rows))
            if before is not None:
                discard(before)
            before = rows
            # All pairs of different labels have a side outside the main label; few classes are outside.
            met = rows.join(self.partners(rows, ~F.col("small")), "node")
            if level == self.levels:
                pairs = self.near(met.filter("small")).unionByName(self.near_all(rows.filter("not small")))
            else:
                pairs = self.near(met)
            self.link(pairs)
            # A partner has met all of its node and need not go further down.
            rows = met.filter("not small").filter(~F.exists("partners", lambda p: p["id"] == F.col("id")))
            last = level == self.levels or rows.isEmpty()
            if last or level & (level - 1) == 0:  # labels only save work; they are made anew ever less often
                self.connect()
            if last:
                break
            rows = rows.select("node", "tree", "path", "id").join(self.classes.select("id", "values"), "id")
            rows = self.branch(rows, level)
        return self.labels


def near_groups(
    docs: DataFrame, width: int = 5, percent: int = 75, trees: int = 8, node_size: int = 16, pivots: int = 8,
    levels: int = 16,
) -> DataFrame:
    """For every row: doc_id, _hash, n_shingles, component_id, kept, first (whether this row is its group's first).

    Documents are linked if their sets' intersection is at least ``percent`` of the
    union; component_id is the smallest doc_id reachable by links. A text without words
    has an empty set and is linked with nothing; a NULL doc_id is nobody's component_id
    unless all rows of its group are NULL; rows of equal doc_id and text are alike. Nodes
    that are still large after ``levels`` levels compare all pairs not yet connected, so
    that none is given up. An empty table gives no rows.
    """
    rows = sets_of(docs, width)
    labels = Join(docs, rows, width, percent, trees, node_size, pivots, levels).run()
    found = rows.select("doc_id", "_hash", "n", "id")
    if labels is not None:
        found = found.join(labels.withColumnRenamed("node", "id"), "id", "left")
    else:
        found = found.withColumn("root", F.lit(None).cast("binary"))
    found = settle(found.withColumn("group", F.coalesce("root", "id")).drop("root", "id"), "groups")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_hash")
    firsts = found.filter("n > 0").groupBy("group").agg(F.min(key).alias("first"))
    found = found.join(firsts, "group", "left")
    first = F.coalesce("first", key)
    return found.select(
        "doc_id", "_hash", F.col("n").alias("n_shingles"), first["doc_id"].alias("component_id"),
        F.col("doc_id").eqNullSafe(first["doc_id"]).alias("kept"), key.eqNullSafe(first).alias("first"),
    )


def near_dedup(docs: DataFrame, **settings) -> DataFrame:
    """One row of each group of near copies, the one with the smallest doc_id, with all its columns.

    Rows without words stay. Rows that repeat a doc_id and a text count as one group, of
    which each stays; exact dedup comes before.
    """
    gone = near_groups(docs, **settings).filter("not first").select(F.col("doc_id").alias("_g_id"), F.col("_hash").alias("_g_hash"))
    gone = settle(gone, "gone")
    if gone.count() <= BROADCAST_GONE:  # of 16 bytes each
        gone = F.broadcast(gone)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_g_id")) & (F.xxhash64(F.coalesce(F.col("text"), F.lit(""))) == F.col("_g_hash"))
    return docs.join(gone, same, "left_anti")

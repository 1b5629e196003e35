"""Substring dedup of every repeated byte span of a least length, by content-defined chunks.

A byte goes if it lies in a span of at least ``min_run`` bytes of which an earlier copy
exists, earlier by (doc_id, hash, place). Such a span is the union of its windows of
``min_run`` bytes, so it is enough to know which windows have an earlier copy.

A gear hash rolls over each text; a text is cut where the hash is the least of
``reach`` neighbouring ones, leftmost of equal ones. So cuts depend on nothing but the bytes
around them, a chunk has at most ``reach`` bytes, and text put in before a passage moves no
cut inside it. Every window holds a whole chunk, the one that begins at the least of the
window's first hashes, and the bytes of the window alone decide which: equal windows hold
equal chunks at equal places. Chunks are known by the digest of their bytes and those of
the closing hash; a window can have a copy only if its chunk's digest occurs again.

The windows of one chunk cover a segment. Of equal segments the first stays and every
window of the others has a copy. Where the segments around equal chunks differ, as at both
ends of a passage, the first of each kind is cut into blocks of eight windows, in step with
the chunk, and those with the same bytes common to their windows are compared in the same
way; where blocks differ, window by window. So no span is missed, however its surroundings
look.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataload.sources.scratch import discard, settle

GEAR = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)
_BYTES = np.random.default_rng(20240301).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C1B  # 3 modulo 8: powers stay apart in their low bits
CHUNKS = "chunk long"
SEGMENTS = "chunk long, kind long, _id long, _hash long, start int, end int"
CONTENTS = "chunk long, _id long, _hash long, base int, at int, content binary"
BLOCKS = "chunk long, core long, kind long, _id long, _hash long, start int, end int, base int"
WINDOWS = "chunk long, kind long, _id long, _hash long, start int, end int"
RESULT = "doc_id long, n_chunks long, n_deleted long, deleted_bytes long, deleted_spans string, text string"
_DOC = ["_id", "_hash"]  # the text's hash tells apart rows that share an id


def gear_width(min_run: int) -> int:
    """Bytes under the rolling hash: the largest power of two that is at most 16 and half of ``min_run``."""
    return 1 << min(4, (min_run // 2).bit_length() - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(max(n, 1), base, np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers))
    return out[0], out[1]


class Digests:
    """64-bit digests of any spans of some bytes, from sums of prefixes."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * powers[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return _mixed(value + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def chunks(data: np.ndarray, min_run: int) -> tuple[np.ndarray, ...]:
    """Start and end (with the closing hash's bytes) of each chunk that has windows, and its first and last window's start.

    A text shorter than ``min_run`` has none.
    """
    none = np.zeros(0, np.int64)
    if len(data) < min_run:
        return none, none, none, none
    size = gear_width(min_run)
    rolled = GEAR[data]
    width = 1
    while width < size:  # sums over twice as many bytes each time
        rolled[width:] = rolled[width:] + (rolled[:-width] << np.uint64(width))
        width *= 2
    hashes = _mixed(rolled[size - 1 :])
    reach = (min_run - size + 1) // 2  # two such stretches of hashes in every window
    least = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)  # of equal ones the leftmost
    width = 1
    while width < reach:
        step = min(width, reach - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    cuts, last = at[first], np.append(first[1:], len(at)) - 1
    windows = len(data) - min_run
    n = int(np.searchsorted(first, windows, "right"))  # every one of these has a next cut
    return cuts[:n], cuts[1 : n + 1] + size, first[:n], np.minimum(last[:n], windows)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, … for each start, ``counts`` many."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - starts, counts)


def _chunked(docs: DataFrame, min_run: int, schema: str) -> DataFrame:
    """CHUNKS or SEGMENTS of every text."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 256):  # rows of 256 texts at a time
                batch = whole.iloc[at : at + 256]
                columns, counts = [], []
                for text in batch["_text"]:
                    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
                    start, end, first, last = chunks(data, min_run)
                    counts.append(len(start))
                    if not len(start):
                        continue
                    digests = Digests(data)
                    found = [digests.of(start, end)]
                    if schema == SEGMENTS:
                        found += [digests.of(first, last + min_run), first, last + min_run]
                    columns.append(found)
                if not columns:
                    continue
                made = [np.concatenate(x) for x in zip(*columns)]
                out = pd.DataFrame({"chunk": made[0]})
                if schema == SEGMENTS:
                    out["kind"] = made[1]
                    out["_id"] = batch["_id"].astype("Int64").repeat(counts).to_numpy()
                    out["_hash"] = batch["_hash"].repeat(counts).to_numpy()
                    out["start"], out["end"] = made[2].astype(np.int32), made[3].astype(np.int32)
                yield out

    return _keyed(docs).mapInPandas(cut, schema)


def _compared(rows: DataFrame, *key: str) -> DataFrame:
    """Rows that are not the first of their kind, and firsts whose key has several kinds: ``is_first`` tells which."""
    place = F.struct(*_DOC, "start")
    counted = settle(rows.groupBy(*key, "kind").agg(F.count("*").alias("n"), F.min(place).alias("first")), "kinds")
    mixed = counted.groupBy(*key).count().filter("count > 1").select(*key, F.lit(True).alias("mixed"))
    kinds = counted.join(mixed, list(key), "left").filter("n > 1 or mixed").drop("n")
    met = rows.join(kinds, [*key, "kind"]).withColumn("is_first", place.eqNullSafe(F.col("first")))
    out = settle(met.filter("not is_first or mixed").drop("first", "mixed", "kind"), "compared")
    discard(counted)
    return out


def _with_text(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The texts of all documents with their places, an array of (start, end); NULL for none."""
    places = places.groupBy(*_DOC).agg(F.collect_set(F.struct("start", "end")).alias("places"))
    places = places.select(*_DOC, F.col("places.start").alias("starts"), F.col("places.end").alias("ends"))
    rows = _keyed(docs)
    same = rows["_id"].eqNullSafe(places["_id"]) & (rows["_hash"] == places["_hash"])
    return rows.join(places, same, "left").select(rows["_id"], rows["_hash"], "_text", "starts", "ends")


def _contents(docs: DataFrame, edges: DataFrame, min_run: int) -> DataFrame:
    """The bytes of some segments, once each, and the place of their chunk."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in range(0, len(batch), 256):  # rows of 256 texts at a time
                some = batch.iloc[part : part + 256]
                numbers, bases, places, counts, contents = [], [], [], [], []
                for text, starts in zip(some["_text"], some["starts"]):
                    data = text.encode("utf-8", "replace")
                    whole = np.frombuffer(data, np.uint8)
                    start, end, first, last = chunks(whole, min_run)
                    which = np.searchsorted(first, np.unique(starts))
                    numbers.append(Digests(whole).of(start[which], end[which]))
                    bases.append(first[which])
                    places.append(start[which])
                    counts.append(len(which))
                    contents += [data[a : b + min_run] for a, b in zip(first[which].tolist(), last[which].tolist())]
                out = some[["_id", "_hash"]].astype({"_id": "Int64"}).iloc[np.repeat(np.arange(len(some)), counts)].reset_index(drop=True)
                out["chunk"], out["content"] = np.concatenate(numbers), contents
                out["base"], out["at"] = np.concatenate(bases).astype(np.int32), np.concatenate(places).astype(np.int32)
                yield out[[c.split()[0] for c in CONTENTS.split(", ")]]

    texts = _with_text(docs, edges).filter("starts is not null")
    return texts.mapInPandas(read, CONTENTS).dropDuplicates([*_DOC, "base"])


def _joined(contents: pd.Series) -> tuple[Digests, np.ndarray, np.ndarray]:
    """Digests over some contents, and the place and the length of each."""
    sizes = contents.str.len().to_numpy(np.int64)
    return Digests(np.frombuffer(b"".join(contents), np.uint8)), np.cumsum(sizes) - sizes, sizes


def blocks(contents: pd.Series, at: np.ndarray, min_run: int, size: int) -> pd.DataFrame:
    """The windows of segments, ``size`` at a time in step with the chunk that begins at ``at``.

    ``of`` is the segment's number; ``core`` digests the bytes common to a whole block, ``kind`` those of the windows it has;
    ``first`` and ``last`` are these windows' starts.
    """
    digests, places, sizes = _joined(contents)
    last = sizes - min_run
    low = (at - last) // size
    counts = at // size - low + 1
    of = np.repeat(np.arange(len(at)), counts)
    end = at[of] - _ranges(low, counts) * size  # the last window's start, if the segment has it
    first, last = np.maximum(0, end - size + 1), np.minimum(last[of], end)
    place = places[of]
    return pd.DataFrame({
        "of": of, "first": first, "last": last,
        "core": digests.of(place + end, place + end - size + 1 + min_run), "kind": digests.of(place + first, place + last + min_run),
    })


def repeated_spans(docs: DataFrame, min_run: int) -> DataFrame:
    """(_id, _hash, start, end): spans that together hold every window of which an earlier copy exists."""
    shared = _chunked(docs, min_run, CHUNKS).groupBy("chunk").count().filter("count > 1").select("chunk")
    met = settle(_chunked(docs, min_run, SEGMENTS).join(shared, "chunk", "left_semi"), "segments")
    segments = _compared(met, "chunk")
    discard(met)
    contents = settle(_contents(docs, segments.filter("is_first"), min_run), "contents")
    size = 8 if min_run >= 16 else 1

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            found = blocks(batch["content"], batch["at"].to_numpy(np.int64) - batch["base"].to_numpy(np.int64), min_run, size)
            out = batch[["chunk", "_id", "_hash", "base"]].astype({"_id": "Int64"}).iloc[found["of"]].reset_index(drop=True)
            out["core"], out["kind"] = found["core"], found["kind"]
            out["start"] = (out["base"] + found["first"]).astype(np.int32)
            out["end"] = (out["base"] + found["last"] + min_run).astype(np.int32)
            yield out[[c.split()[0] for c in BLOCKS.split(", ")]]

    met = settle(contents.mapInPandas(cut, BLOCKS), "blocks")
    parts = _compared(met, "chunk", "core")
    discard(met)

    def window(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            digests, places, _ = _joined(batch["content"])
            starts = batch["start"].to_numpy(np.int64)
            counts = batch["end"].to_numpy(np.int64) - starts - min_run + 1
            out = batch[["chunk", "_id", "_hash"]].astype({"_id": "Int64"}).iloc[np.repeat(np.arange(len(batch)), counts)]
            begun = _ranges(starts, counts)
            place = begun + np.repeat(places - batch["base"].to_numpy(np.int64), counts)
            out["kind"] = digests.of(place, place + min_run)
            out["start"], out["end"] = begun.astype(np.int32), (begun + min_run).astype(np.int32)
            yield out[[c.split()[0] for c in WINDOWS.split(", ")]]

    edges, held = parts.filter("is_first").drop("is_first"), contents.select("*")
    same = edges["_id"].eqNullSafe(held["_id"]) & (edges["_hash"] == held["_hash"]) & (edges["base"] == held["base"])
    edges = edges.join(held, same).select(*[edges[c] for c in ("chunk", "_id", "_hash", "start", "end", "base")], "content")
    met = settle(edges.mapInPandas(window, WINDOWS), "windows")
    windows = _compared(met, "chunk")
    discard(met, contents)
    later = [x.filter("not is_first").select(*_DOC, "start", "end") for x in (segments, parts, windows)]
    spans = settle(later[0].unionByName(later[1]).unionByName(later[2]), "repeated")
    discard(segments, parts, windows)
    return spans


def deleted_spans(data: np.ndarray, starts, ends) -> list[tuple[int, int]]:
    """The union of byte spans, each cut back to whole characters."""
    starts, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    breaks = np.flatnonzero(starts[1:] > reach[:-1])
    spans = []
    for a, b in zip(starts[np.append(0, breaks + 1)].tolist(), reach[np.append(breaks, len(reach) - 1)].tolist()):
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while a < b and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            spans.append((a, b))
    return spans


def substring_dedup(docs: DataFrame, min_run: int = 128) -> DataFrame:
    """Per row: doc_id, segment counts, deleted bytes and spans (UTF-8 bytes, end exclusive), remaining text.

    A byte goes if it lies in at least ``min_run`` bytes of which an earlier copy exists;
    copies inside one text count, also when they overlap. A deleted span that would begin
    or end inside a character is cut back to whole characters. ``n_chunks`` counts a
    text's chunks that have windows and ``n_deleted`` those whose windows lie in deleted spans.
    ``min_run`` is 2 at least. A task needs about 80 bytes for each byte of its longest text.

    NULL texts, and texts of less than ``min_run`` bytes, have no chunks; a NULL doc_id comes before
    all others; rows with equal doc_id and text are one document and share the result; an
    empty table gives no rows. Other columns are not read.
    """

    if min_run < 2:
        raise ValueError("min_run must be 2 at least")

    def delete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, starts, ends in zip(batch["_id"].astype("Int64"), batch["_text"], batch["starts"], batch["ends"]):
                data = text.encode("utf-8", "replace")
                whole = np.frombuffer(data, np.uint8)
                _, _, begun, last = chunks(whole, min_run)
                spans = deleted_spans(whole, starts, ends) if starts is not None else []
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                left = b"".join([*kept, data[at:]]).decode() if spans else text
                gone = sum(int(((begun >= a) & (last + min_run <= b)).sum()) for a, b in spans)
                out.append((doc_id, len(begun), gone, sum(b - a for a, b in spans), ",".join(f"{a}:{b}" for a, b in spans), left))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")]).astype({"doc_id": "Int64"})

    return _with_text(docs, repeated_spans(docs, min_run)).mapInPandas(delete, RESULT)

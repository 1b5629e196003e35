"""Best-fit packing with certified bin counts.

Documents become token pieces of at most ``capacity`` tokens; pieces are dealt to
partitions of bounded size, and each partition is packed by best-fit decreasing. A lower
bound from dual-feasible functions certifies a partition whose bin count meets it. The
partitions with a gap exchange documents: their imperfect bins are opened, the pieces
are dealt anew over fewer partitions and packed again, until every partition is
certified, or the number of all bins is by one bound over all pieces, or an exchange no
longer saves a bin.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataload.llm.bpe import local_copy, share_file
from strataload.llm.words import Memo
from strataload.sources.scratch import settle, small_batches

END = 2
PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"
PLACES = "row long, piece int, length long, task long, sequence_id long, offset long, gap boolean, bound long, bins long"


class TokenizerMemo(Memo):
    """Piece-wise encoding by a tokenizer file. New pieces are encoded as one text and told apart by their bytes.

    Plain pieces, whose matches are known, are written in the tokenizer's own alphabet and parted
    by spaces, so that the tokenizer need not look for matches in them or map their bytes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        split = self.tokenizer.pre_tokenizer
        self.plain = None
        if isinstance(split, ByteLevel) and split.use_regex and not split.add_prefix_space and self.tokenizer.normalizer is None:
            self.plain = Tokenizer.from_file(path)
            self.plain.encode_special_tokens = True
            self.plain.pre_tokenizer = WhitespaceSplit()
        # The byte-level alphabet has one character for each byte.
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, rank in self.tokenizer.get_vocab().items():
            self.sizes[rank] = len(token)
        super().__init__(self._encode_many)

    def _encode_many(self, parts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(parts)
        plain, joined = [], []
        for k, part in enumerate(parts):
            written = plain_matches(part) if self.plain else None
            if written:
                plain.append((k, written))
            elif part[:1] in (" ", "\n") and not part[1:2].isspace() and not part[-1:].isspace():
                joined.append((k, part))
            else:
                out[k] = np.array(self._ids(self.tokenizer, part), "<u4").tobytes()
        for tokenizer, written, gap in ((self.plain, plain, " "), (self.tokenizer, joined, "")):
            for at in range(0, len(written), 512):
                some = written[at : at + 512]
                ids = np.array(self._ids(tokenizer, gap.join([x for _, x in some])), "<u4")
                ends = np.cumsum([len(parts[k].encode()) for k, _ in some])
                cuts = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1
                data, before = ids.tobytes(), 0
                for (k, _), cut in zip(some, (cuts * 4).tolist()):
                    out[k], before = data[before:cut], cut
        return out

    @staticmethod
    def _ids(tokenizer, text: str) -> list[int]:
        # The fast call leaves out the offsets, which nothing here reads.
        return tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids if text else []


#: A space belongs to the word's match, a line break is a match of its own.
_BEGUN = {" ": "\u0120", "\n": "\u010a "}


def plain_matches(part: str) -> str | None:
    """The matches of a space or line break, ASCII letters and perhaps a stop, in the byte-level alphabet; None for other parts."""
    word, stop = (part[1:-1], " " + part[-1]) if part[-1:] in (".", ",") else (part[1:], "")
    if not word.isascii() or not word.isalpha():
        return None
    begun = _BEGUN.get(part[0])
    return begun and begun + word + stop


_memos: dict[str, TokenizerMemo] = {}


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024) -> DataFrame:
    """Each document's tokens and the end id, cut into pieces.

    Only documents longer than ``capacity`` are cut, and only their first piece is
    shorter. NULL text is empty text: one piece that holds the end id alone. ``row``
    tells repeated rows apart; it is settled with the pieces.
    """
    name = share_file(docs.sparkSession, tokenizer_path)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if name not in _memos:
            _memos[name] = TokenizerMemo(local_copy(name, tokenizer_path))
        memo, end = _memos[name], np.array([END], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, row, ids in zip(batch["doc_id"], batch["row"], memo.encode([t or "" for t in batch["text"]])):
                ids += end
                n = len(ids) // 4
                first = n % capacity or capacity
                starts = [0, *range(first, n, capacity)]
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
                    rows.append((doc_id, row, piece, a, b - a, zlib.crc32(ids[a * 4 : b * 4])))
            found = pd.DataFrame(rows, columns=["doc_id", "row", "piece", "start", "length", "ids_crc32"])
            yield found.astype({"doc_id": "Int64"})

    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    with small_batches(docs.sparkSession):
        return settle(rows.mapInPandas(cut, PIECES), "pieces")


def bins_bound(counts: np.ndarray, capacity: int) -> int:
    """A lower bound of the bins needed for ``counts[x]`` pieces of each size x.

    The largest of the sums of dual-feasible functions: the identity; those that raise
    sizes above capacity - e to a whole bin and drop those below e; and the rounding
    functions of k + 1 equal parts.
    """
    sizes = np.arange(capacity + 1)
    best = -(-int((counts * sizes).sum()) // capacity)
    whole = np.cumsum(counts[::-1])[::-1]  # pieces of at least a size
    mass = np.concatenate([[0], np.cumsum(counts * sizes)])
    for e in range(1, capacity // 2 + 1):
        raised = int(whole[capacity - e + 1]) if e > 0 else 0
        kept = int(mass[capacity - e + 1] - mass[e])
        best = max(best, raised - (-kept // capacity))
    for k in range(1, 65):
        parts = (k + 1) * sizes
        value = np.where(parts % capacity == 0, sizes * k, parts // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The bin and the offset of each piece, and the number of bins."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by the room left
    rooms, count = 0, 0  # bit r of rooms: a bin with room r is open
    for k, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = free[room].pop()
            if not free[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen = capacity, count
            count += 1
        bins[k], offsets[k] = chosen, capacity - room
        if room > size:
            free[room - size].append(chosen)
            rooms |= 1 << (room - size)
    return bins, offsets, count


def _packed(pieces: DataFrame, parts: int, first: int, turn: int, capacity: int) -> DataFrame:
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["row", "piece"], ignore_index=True)
        lengths = rows["length"].to_numpy()
        bins, offsets, count = best_fit_decreasing(lengths, capacity)
        bound = bins_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        fill = np.bincount(bins, lengths, count)
        task = int(rows["task"][0]) + first
        return pd.DataFrame({
            "row": rows["row"], "piece": rows["piece"], "length": lengths, "task": task,
            "sequence_id": task * (1 << 32) + bins, "offset": offsets,
            # Best fit leaves at most one bin half empty, which others' pieces may fill.
            "gap": (fill[bins] < capacity) & ((count > bound) | (2 * fill[bins] <= capacity)), "bound": bound, "bins": count,
        })

    dealt = pieces.select("row", "piece", "length", F.pmod(F.xxhash64("row", "piece", F.lit(turn)), F.lit(parts)).alias("task"))
    return settle(dealt.groupBy("task").applyInPandas(pack, PLACES), "packed")


def pack_pieces(pieces: DataFrame, capacity: int = 1024, per_partition: int = 65_536, turns: int = 6) -> DataFrame:
    """The bin and the place of every piece, and whether its partition's bin count is certified.

    A partition holds about ``per_partition`` pieces, whatever their lengths, so a task
    needs memory for that many. Certified partitions give their half-empty bin into the
    exchange as well. An exchange is kept only if it needs fewer bins; exchanges end when
    all bins together meet the bound of all pieces' lengths, or after ``turns``, when
    the packing stays as it is, complete but perhaps not certified.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most one row per length
        counts[row["length"]] = row["count"]
    least = bins_bound(counts, capacity)
    parts = -(-int(counts.sum()) // per_partition) or 1
    first, done, closed = 0, [], 0
    now = _packed(pieces, parts, first, 0, capacity)
    for turn in range(1, turns + 1):
        first += parts
        bins = now.groupBy("sequence_id").agg(F.count("*").alias("n"), F.first("gap").alias("gap"))
        found = {r["gap"]: r for r in bins.groupBy("gap").agg(F.count("*").alias("bins"), F.sum("n").alias("n")).collect()}
        if True not in found or closed + sum(r["bins"] for r in found.values()) == least:
            break
        parts = -(-found[True]["n"] // per_partition)
        again = _packed(now.filter("gap"), parts, first, turn, capacity)
        if again.select("sequence_id").distinct().count() >= found[True]["bins"]:
            break
        done.append(now.filter("not gap"))
        closed += found[False]["bins"] if False in found else 0
        now = again
    for other in done:
        now = now.unionByName(other)
    total = now.select("sequence_id").distinct().count()
    return now.withColumn("certified", (F.col("bins") == F.col("bound")) | F.lit(total == least))


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 1024, per_partition: int = 65_536
) -> DataFrame:
    """Every piece of every document with its sequence and place, gapless from 0.

    Empty tables give no rows; repeated rows are packed each on their own; a NULL doc_id
    is kept as NULL; other columns are not read. ``certified``: the partition that packed
    this sequence, or all of them together, needed no more bins than the lower bound.
    """
    pieces = token_pieces(docs, tokenizer_path, capacity)
    places = pack_pieces(pieces, capacity, per_partition).select("row", "piece", "sequence_id", "offset", "certified")
    return pieces.join(places, ["row", "piece"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified"
    )

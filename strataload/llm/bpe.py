"""Byte-level BPE by longest matches and backtracking.

A token sequence is what the merges produce exactly if every two neighbours are
compatible: merging the bytes of both together, in rank order, ends with just these two.
So a text is encoded by taking the longest token at each place (found by an
Aho-Corasick automaton over the vocabulary), falling back to the next shorter token
that starts there while it is not compatible with the one before, and taking the token
before back when none is left. A place that was given up is never tried again, so the
work is linear in the text. Compatibility of a pair is remembered.

The automaton's strings are the tokens' bytes read as Latin-1, one character a byte.
"""

from __future__ import annotations

import base64
import filecmp
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from strataload.llm.words import Memo


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Bpe:
    """An encoder for one rank table; all tables are derived from it on creation."""

    def __init__(self, ranks: dict[bytes, int]):
        self.token = {rank: token for token, rank in ranks.items()}
        self.rank = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.known: dict[tuple[int, int], bool] = {}
        for text, rank in sorted(self.rank.items(), key=lambda x: x[1]):
            self.halves[rank] = self._last_merge(text, rank)
            if self.halves[rank]:
                self.merged[self.halves[rank]] = rank
        self.known.clear()
        # Tokens that no merges make are never part of an encoding.
        self.rank = {t: r for t, r in self.rank.items() if len(t) == 1 or self.halves[r]}
        self.text = {r: t for t, r in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self.automaton = ahocorasick.Automaton()
        for text, rank in self.rank.items():
            self.automaton.add_word(text, rank)
        self.automaton.make_automaton()
        self.shorter: dict[str, str | None] = {}
        for text in self.rank:
            start = text[:-1]
            while start and start not in self.rank:
                start = start[:-1]
            self.shorter[text] = start or None

    def _last_merge(self, text: str, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte or a token that no merges make."""
        for cut in range(1, len(text)):
            left, right = self.rank.get(text[:cut]), self.rank.get(text[cut:])
            if left is not None and right is not None and left < rank and right < rank:
                if self.compatible(left, right):
                    return left, right
        return None

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes together end with these two tokens.

        Undoes the merges on both sides in falling rank. If the two parts that touch the
        border form a token that ranks before the merge that would follow, the merges
        would have crossed the border.
        """
        pair = (left, right)
        found = self.known.get(pair)
        if found is not None:
            return found
        bound, fits = len(self.token) + 1, True
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < bound:
                fits = False
                break
            a, b = self.halves.get(left), self.halves.get(right)
            # Of two equal ranks the left one merges first, so the right one is undone first.
            if a is not None and (b is None or left > right):
                bound, left = left, a[1]
            elif b is not None:
                bound, right = right + 1, b[0]
            else:
                break
        if len(self.known) > 500_000:
            self.known.clear()
        self.known[pair] = fits
        return fits

    def _longest(self, text: str, place: int) -> str | None:
        """The longest token that starts at ``place``."""
        ahead = text[place : place + self.longest]
        ahead = ahead[: self.automaton.longest_prefix(ahead)]
        while ahead not in self.rank:
            ahead = ahead[:-1]
        return ahead

    def encode(self, data: bytes) -> list[int]:
        text = data.decode("latin-1")
        rank, known = self.rank, self.known
        ids: list[int] = []
        ends: list[int] = []
        closed: set[int] = set()
        place, size = 0, len(text)
        token = self._longest(text, 0) if text else None
        while place < size:
            while token is not None:
                now, end = rank[token], place + len(token)
                if end not in closed:
                    pair = (ids[-1], now) if ids else None
                    if pair is None or (known[pair] if pair in known else self.compatible(*pair)):
                        ids.append(now)
                        ends.append(end)
                        place = end
                        token = self._longest(text, end) if end < size else None
                        break
                token = self.shorter[token]
            else:
                if not ids:
                    raise ValueError("the vocabulary lacks single bytes")
                closed.add(place)
                token = self.shorter[self.text[ids.pop()]]
                ends.pop()
                place = ends[-1] if ends else 0
        return ids

    def decode(self, ids) -> bytes:
        return b"".join([self.token[i] for i in ids])


class TextEncoder:
    """Splits texts by a pattern and encodes each match on its own."""

    def __init__(self, ranks_path: str, pattern: str):
        self.bpe = Bpe(read_ranks(ranks_path))
        self.matches = regex.compile(pattern).findall
        self.memo = Memo(self._encode_many)
        self.matched: dict[str, bytes] = {}

    def _encode_many(self, parts: list[str]) -> list[bytes]:
        if len(self.matched) > 300_000:
            self.matched.clear()
        return [b"".join(map(self._match, self.matches(part))) for part in parts]

    def _match(self, match: str) -> bytes:
        ids = self.matched.get(match)
        if ids is None:
            ids = array("I", self.bpe.encode(match.encode())).tobytes()
            if len(match) <= self.memo.longest:
                self.matched[match] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.memo.encode(texts)

    def decode(self, data: bytes) -> bytes:
        return self.bpe.decode(array("I", data))


@lru_cache(maxsize=1)
def _encoder(name: str, pattern: str, on_driver: str) -> TextEncoder:
    return TextEncoder(local_copy(name, on_driver), pattern)


def share_file(spark, path: str) -> str:
    """Send a vocabulary file to all executors, present and future; returns its name there.

    Executors know a file by its base name, so another content under a name in use is refused.
    """
    name = path.rsplit("/", 1)[-1]
    if not any(str(f).rsplit("/", 1)[-1] == name for f in spark.sparkContext.listFiles):
        spark.sparkContext.addFile(path)
    elif not filecmp.cmp(SparkFiles.get(name), path, shallow=False):
        raise ValueError(f"another file named {name} is in use in this session; rename one of them")
    return name


def local_copy(name: str, path: str) -> str:
    import os

    shared = SparkFiles.get(name)
    return shared if os.path.exists(shared) else path


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids (32-bit little-endian, as binary) and decoded (binary) of every whole text.

    NULL and empty texts have no ids. Rows are independent: repeats and NULL ids are kept
    as they are, other columns are not read, an empty table gives no rows.
    """
    name = share_file(docs.sparkSession, ranks_path)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(name, pattern, ranks_path)
        for batch in batches:
            ids = encoder.encode([t or "" for t in batch["text"]])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": ids, "decoded": [encoder.decode(x) for x in ids]})

    return docs.select("doc_id", "text").mapInPandas(encode, "doc_id long, ids binary, decoded binary")


def token_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``encode_documents`` reduced to doc_id, n_tokens, ids_sha256 and decoded_sha256 inside the same task."""
    name = share_file(docs.sparkSession, ranks_path)

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(name, pattern, ranks_path)
        for batch in batches:
            ids = encoder.encode([t or "" for t in batch["text"]])
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "n_tokens": [len(x) // 4 for x in ids],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(encoder.decode(x)).hexdigest() for x in ids],
            })

    return docs.select("doc_id", "text").mapInPandas(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )

"""Splitting text where a byte-level pre-tokenizer is certain to split, and remembering what was seen."""

from __future__ import annotations

import re

# Python's white space includes all of Unicode's, so a split is never made where the pattern makes none.
_INNER = re.compile(r"(?<=\S) (?=\S)")


def pieces(text: str) -> list[str]:
    """Parts of any text that can be encoded each on its own.

    A single space between two visible characters always starts a new match of the
    pre-tokenizer's pattern, and belongs to it. The parts come without that space.
    """
    return _INNER.split(text) if text else []


def _visible_ends(part: str) -> bool:
    """Whether a part, without a leading line break, begins and ends with visible characters."""
    part = part[1:] if part[:1] == "\n" else part
    return part != "" and not part[0].isspace() and not part[-1].isspace()


def _written(part: str) -> str:
    return part if part[0] == "\n" else " " + part


class Memo:
    """Encodes texts piece by piece and remembers the pieces.

    ``encode_many`` maps strings to bytes. Two generations of at most ``entries`` pieces
    each bound the memory: when the younger is full, it becomes the older, and pieces
    still in use move over. Pieces of more than ``longest`` characters are not kept.
    """

    def __init__(self, encode_many, entries: int = 400_000, longest: int = 48):
        self.encode_many, self.entries, self.longest = encode_many, entries, longest
        self.inner: dict[str, bytes] = {}  # pieces after a space or a line break
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The encoding of each text; new pieces of some texts at a time are encoded in one call."""
        return [ids for at in range(0, len(texts), 64) for ids in self._encode_some(texts[at : at + 64])]

    def _encode_some(self, texts: list[str]) -> list[bytes]:
        # A line break between visible characters is a match of its own: "a\nb c" gives "\na", "\nb", "c",
        # of which the first break, put there to tell a text's start from a word, is taken off again below.
        have, new = self.inner, {}
        visible: set[str] = set()
        parts, got, gaps = [], [], []
        for text in texts:
            own = ("\n" + text).replace("\n", " \n").split(" ")[1:]
            ids = list(map(have.get, own))
            missing = [k for k, x in enumerate(ids) if x is None] if None in ids else []
            # Kept pieces have visible ends, so only missing ones can show uneven spaces.
            unseen = {own[k] for k in missing} - visible
            if all(map(_visible_ends, unseen)):
                visible |= unseen
            else:
                own = pieces(text)
                ids = [None, *map(have.get, own[1:])] if own else []
                missing = [k for k, x in enumerate(ids) if x is None]
                if own:
                    own[0] = " " + own[0]  # a text's start; no other part holds a leading space
            new.update(dict.fromkeys([own[k] for k in missing]))
            parts.append(own)
            got.append(ids)
            gaps.append(missing)
        found = {p: self.older[p] for p in new if p in self.older}
        rest = [p for p in new if p not in found]
        found.update(zip(rest, self.encode_many([p[1:] if p[0] == " " else _written(p) for p in rest])))
        out = []
        for own, ids, missing in zip(parts, got, gaps):
            for k in missing:
                ids[k] = found[own[k]]
            if own and own[0][0] == "\n":
                ids[0] = ids[0][4:]
            out.append(b"".join(ids))
        have.update((p, x) for p, x in found.items() if len(p) <= self.longest and (p in visible or _visible_ends(p)))
        if len(have) > self.entries:
            self.older, self.inner = have, {}
        return out

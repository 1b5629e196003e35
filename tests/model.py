"""The history rules written row by row in plain Python, to check the operator by."""

from __future__ import annotations

from datetime import datetime, timedelta

OPEN = datetime(3000, 12, 31)
EPOCH = datetime(2020, 1, 1)


def day(n: int | None) -> datetime | None:
    return None if n is None else EPOCH + timedelta(days=n)


def changed(values, before, null_mode: str) -> bool:
    if null_mode == "null_safe":
        return before is None or any(v != b for v, b in zip(values, before))
    for i, value in enumerate(values):
        earlier = None if before is None else before[i]
        if value is not None and value != (earlier if earlier is not None else "not_found"):
            return True
    return False


def load(dim: list[dict], staged: list[dict], loaddate: datetime, null_mode: str = "reference") -> list[dict]:
    """Rows are dicts of key, entity, start, end, values, loaddate."""
    known = {row["key"] for row in dim}
    arrived = {row["entity"] for row in staged}
    last = datetime.max

    def place(row):
        return (row["start"] or last, row["key"])

    kept = []
    for entity in arrived:
        rows = sorted(
            [dict(r, new=False) for r in dim if r["entity"] == entity]
            + [dict(r, new=True) for r in staged if r["entity"] == entity and r["key"] not in known],
            key=place,
        )
        before = None
        for row in rows:
            if row["new"] and changed(row["values"], before, null_mode):
                kept.append(dict(row, loaddate=loaddate))
            before = row["values"]
    affected = {row["entity"] for row in kept}
    result = [dict(r) for r in dim if r["entity"] not in affected]
    for entity in affected:
        rows = sorted([dict(r) for r in [*dim, *kept] if r["entity"] == entity], key=place)
        for row, after in zip(rows, [*rows[1:], None]):
            row["end"] = OPEN if after is None or after["start"] is None else after["start"]
        result += rows
    return result

"""Key expressions, all built-in functions so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataload.functions.dates import micros_text
from strataload.schemas import NULL_TOKEN


def entity_id(*parts: Column | str) -> Column:
    """Parts joined by an underscore; NULL as soon as one part is NULL."""
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    joined = [texts[0]]
    for text in texts[1:]:
        joined += [F.lit("_"), text]
    return F.concat(*joined)


def version_key(entity: Column, change: Column) -> Column:
    """Hash of an entity and its change time in microseconds; NULLs hash as empty text (H4, H9)."""
    when = F.coalesce(micros_text(change), F.lit(""))
    return F.md5(F.concat(F.coalesce(entity, F.lit("")), F.lit("|"), when))


def surrogate_key(*columns: Column | str) -> Column:
    """Hash of several columns as text, a NULL being a text of its own (H5)."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.md5(F.concat_ws("-", *[F.coalesce(t, F.lit(NULL_TOKEN)) for t in texts]))


def packed(key: Column) -> Column:
    """A text as bytes to be shuffled, hashes of 32 hex digits in 17 of them; ``unpacked`` gives it back."""
    digits = F.unhex(key)
    is_hash = (F.length(key) == 32) & (F.lower(F.hex(digits)) == key)
    return F.when(is_hash, F.concat(F.unhex(F.lit("01")), digits)).otherwise(F.concat(F.unhex(F.lit("00")), key.cast("binary")))


def unpacked(key: Column) -> Column:
    rest = F.substring(key, 2, 2**31 - 1)
    return F.when(F.substring(key, 1, 1) == F.unhex(F.lit("01")), F.lower(F.hex(rest))).otherwise(rest.cast("string"))

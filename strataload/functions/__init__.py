"""Column functions: keys, dates and load-range predicates."""

from strataload.functions.dates import iso_date, micros_text, month_of, seconds_text, yyyymmdd
from strataload.functions.keys import entity_id, packed, surrogate_key, unpacked, version_key
from strataload.functions.ranges import LATEST_LOAD, LoadRange, latest_load, on_load, where_scope

__all__ = [
    "LATEST_LOAD", "LoadRange", "entity_id", "iso_date", "latest_load", "micros_text", "month_of", "on_load",
    "packed", "seconds_text", "surrogate_key", "unpacked", "version_key", "where_scope", "yyyymmdd",
]

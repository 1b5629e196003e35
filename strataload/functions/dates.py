"""Dates kept as yyyymmdd integers, and the text forms of dates and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(yyyymmdd_col: Column | str) -> Column:
    """yyyymm of a yyyymmdd integer, by integer division rather than through text (H6)."""
    column = F.col(yyyymmdd_col) if isinstance(yyyymmdd_col, str) else yyyymmdd_col
    return F.floor(column / 100).cast("int")


def yyyymmdd(when: Column) -> Column:
    """Date or timestamp to a yyyymmdd integer."""
    return (F.year(when) * 10000 + F.month(when) * 100 + F.dayofmonth(when)).cast("int")


def iso_date(when: Column) -> Column:
    """Date as yyyy-MM-dd text, so that every tracked column is text."""
    return F.substring(when.cast("string"), 1, 10)


def seconds_text(when: Column) -> Column:
    """Zone-free timestamp as yyyy-MM-dd HH:mm:ss (H9).

    Cast and cut, because date_format would read it in the session's time zone.
    """
    return F.substring(when.cast("string"), 1, 19)


def micros_text(when: Column) -> Column:
    """Zone-free timestamp with all six digits of its fraction."""
    fraction = F.rpad(F.substring(when.cast("string"), 21, 6), 6, "0")
    return F.concat(seconds_text(when), F.lit("."), fraction)

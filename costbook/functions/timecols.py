"""Time expressions on UTC-holding ``timestamp_ntz`` columns."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(value: datetime) -> Column:
    """A ``timestamp_ntz`` literal, so comparisons with raw columns need no
    cast on the column side and reach the Parquet scan as pushed filters.

    Built from text: a Python ``datetime`` handed to ``F.lit`` would be read
    in the driver process's local zone."""
    return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def date_lit(value: date) -> Column:
    """A DATE literal, built from text for the same reason as :func:`ntz`."""
    return F.lit(value.isoformat()).cast("date")


def in_range(col: str | Column, lo: datetime, hi: datetime) -> Column:
    """Half-open ``lo <= col < hi`` on the raw column."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= ntz(lo)) & (c < ntz(hi))


def between_closed(col: str | Column, lo: datetime, hi: datetime) -> Column:
    """``col BETWEEN lo AND hi``, both ends included."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= ntz(lo)) & (c <= ntz(hi))


def local_date(col: str | Column, zone: str) -> Column:
    """``DATE(ts, zone)`` for a UTC-holding ``timestamp_ntz``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), c))


def trunc_minute(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_trunc("minute", c).cast("timestamp_ntz")


def trunc_hour(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_trunc("hour", c).cast("timestamp_ntz")


def month_labels(d: str | Column) -> dict[str, Column]:
    """``year`` ('2024') and ``year_month`` ('2024-01') of a DATE column."""
    c = F.col(d) if isinstance(d, str) else d
    return {"year": F.date_format(c, "yyyy"), "year_month": F.date_format(c, "yyyy-MM")}


# Day-partitioned telemetry exports: the partition column that holds the UTC
# day of a timestamp column.  Only the day of the very column that a window
# filters may prune; a job's creation day says nothing certain of its start.
DAY_PARTITION_OF = {
    "creation_time": "creation_date",
    "start_time": "start_date",
    "period_start": "period_date",
}


def day_partition_bounds(columns: list[str], column: str, lo: datetime, hi: datetime) -> Column:
    """The partition predicate implied by ``lo <= column <= hi`` (or ``< hi``).

    Present only when the frame carries the day partition of ``column``.  A
    partition's rows have that day, so no row that the row filter keeps is lost.
    """
    part = DAY_PARTITION_OF.get(column)
    if part not in columns:
        return F.lit(True)
    return (F.col(part) >= date_lit(lo.date())) & (F.col(part) <= date_lit(hi.date()))

"""Units and the rounding rules of the slot and byte roll-ups.

Sums are taken over integers (bytes, milliseconds, whole hundreds of slot
seconds) and divided once, so results do not depend on row order.  Division
chains keep the scripts' order, e.g. ``s / 3600 * 60 * 100``: floating point
does not reassociate and the result differs for some sums (7500 -> 125.01).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from costbook.constants import GIB, SLOT_ROUNDING, TIB  # noqa: F401  (units re-exported)


def ceil_hundreds(x: Column) -> Column:
    """``CEIL(x / 100) * 100`` kept as a whole number (bigint)."""
    return F.ceil(x / F.lit(float(SLOT_ROUNDING))) * F.lit(SLOT_ROUNDING)


def slot_hour_cents(slot_sec_minutes_sum: Column) -> Column:
    """``CEIL(SUM(m) / 3600 * 60 * 100)``: slot-hours in whole hundredths,
    from the summed per-minute values ``m``, in the scripts' operation order."""
    x = slot_sec_minutes_sum.cast("double") / F.lit(3600.0) * F.lit(60.0) * F.lit(100.0)
    return F.ceil(x)


def slot_hours(slot_sec_minutes_sum: Column) -> Column:
    """``CEIL(SUM(m) / 3600 * 60 * 100) / 100``."""
    return slot_hour_cents(slot_sec_minutes_sum).cast("double") / F.lit(100.0)


def ms_between(start: str | Column, end: str | Column) -> Column:
    """``TIMESTAMP_DIFF(end, start, MILLISECOND)`` as bigint."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("MILLISECOND", s, e)

"""Broadcast of small lookup tables, behind a check of their size in bytes.

Beyond the bound the join stays a shuffle join, where adaptive execution can
still split a skewed key; the result is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Per-project lists (reservations and their editions, administration
# projects in use) are far below this even in a large organisation.
DEFAULT_MAX_BYTES = 32 << 20
_ROW_OVERHEAD = 64


def size_bytes(df: DataFrame) -> int:
    """Measured size of ``df``: its values as text, plus a fixed overhead a row."""
    width = F.lit(_ROW_OVERHEAD)
    for c in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return df.agg(F.sum(width.cast("long"))).first()[0] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` measures at most ``max_bytes``, else ``df``."""
    return F.broadcast(df) if size_bytes(df) <= max_bytes else df

"""costbook: warehouse cost and usage marts built as Spark DataFrame plans.

Every pipeline takes an explicit :class:`costbook.asof.AsOf` clock, so a rerun
with the same clock and inputs gives the same rows.
"""

from costbook.asof import AsOf

__all__ = ["AsOf"]

"""Reservation id parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from costbook.constants import ADMIN_PROJECT_DROP, ADMIN_PROJECT_PATTERN


def admin_project(reservation_id: str | Column) -> Column:
    """Administration project of a reservation id ``project:location.name``.

    Everything up to the last colon, with all colons removed, as the
    scheduled script writes it (``example.com:p:loc.r`` gives
    ``example.comp``).  An id without a colon gives NULL.
    """
    c = F.col(reservation_id) if isinstance(reservation_id, str) else reservation_id
    return F.replace(F.regexp_substr(c, F.lit(ADMIN_PROJECT_PATTERN)), F.lit(ADMIN_PROJECT_DROP), F.lit(""))

"""Column-level helpers: time windows, units, id parsing.  All are built-in
Spark expressions, so they stay inside whole-stage code generation."""

from costbook.functions.timecols import (  # noqa: F401
    between_closed,
    date_lit,
    day_partition_bounds,
    in_range,
    local_date,
    month_labels,
    ntz,
    trunc_hour,
    trunc_minute,
)
from costbook.functions.units import (  # noqa: F401
    GIB,
    TIB,
    ceil_hundreds,
    ms_between,
    slot_hour_cents,
    slot_hours,
)
from costbook.functions.ids import admin_project  # noqa: F401

"""The as-of clock.

Nothing in the library calls ``current_date()`` or ``current_timestamp()``:
every date window, date stamp and month label is derived here, on the driver,
from one UTC instant and one time zone, and enters the plan as a literal.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from costbook.constants import RECENT_WINDOW_LAG_MINUTES, REGION, ZONE

DEFAULT_REGION = REGION
DEFAULT_ZONE = ZONE


def _month_start(d: date, shift: int = 0) -> date:
    m = d.year * 12 + (d.month - 1) + shift
    return date(m // 12, m % 12 + 1, 1)


@dataclass(frozen=True)
class AsOf:
    """A run's clock: ``instant`` is a naive datetime holding UTC."""

    instant: datetime
    zone: str = DEFAULT_ZONE
    region: str = DEFAULT_REGION

    @staticmethod
    def parse(text: str, zone: str = DEFAULT_ZONE, region: str = DEFAULT_REGION) -> "AsOf":
        return AsOf(datetime.fromisoformat(text).replace(tzinfo=None), zone, region)

    # --- local wall clock -------------------------------------------------
    @property
    def local_now(self) -> datetime:
        """CURRENT_DATETIME(zone): the local wall clock, naive."""
        aware = self.instant.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(self.zone))
        return aware.replace(tzinfo=None)

    @property
    def today(self) -> date:
        """CURRENT_DATE(zone)."""
        return self.local_now.date()

    @property
    def yesterday(self) -> date:
        return self.today - timedelta(days=1)

    def month_start(self, shift: int = 0) -> date:
        """First day of the local month ``shift`` months from today's."""
        return _month_start(self.today, shift)

    # --- conversions ------------------------------------------------------
    def utc_of_local(self, local: datetime | date) -> datetime:
        """The UTC instant (naive) at which the local wall clock shows ``local``."""
        if not isinstance(local, datetime):
            local = datetime(local.year, local.month, local.day)
        aware = local.replace(tzinfo=ZoneInfo(self.zone)).astimezone(timezone.utc)
        return aware.replace(tzinfo=None)

    def local_date_range_utc(self, first: date, end: date) -> tuple[datetime, datetime]:
        """UTC bounds ``[lo, hi)`` of the instants whose local date is in ``[first, end)``."""
        return self.utc_of_local(first), self.utc_of_local(end)

    # --- the windows of the scripts ---------------------------------------
    def month_window_utc(self, months_back: int = 0) -> tuple[datetime, datetime]:
        """Local months ``[m0 - months_back, m1)`` as a half-open UTC range.

        ``DATE_TRUNC(local_date, MONTH) BETWEEN x AND today`` with x in
        ``(m-1, m0]`` is the same set as ``local_date in [m0, m1)``; writing it
        as a range on the raw column lets the scan prune row groups.
        """
        return self.local_date_range_utc(self.month_start(-months_back), self.month_start(1))

    def recent_window(self, mode: str = "as_written") -> tuple[datetime, datetime]:
        """Closed range ``[lo, hi]`` of the "yesterday until five minutes ago" filter.

        ``as_written`` keeps the scheduled scripts' reading: the local date of
        yesterday and the local wall clock minus five minutes are both taken
        as if they were UTC.  ``previous_local_day`` is the opt-in correction:
        the whole previous local day and today's local hours, as true instants.
        """
        start_local = datetime(self.yesterday.year, self.yesterday.month, self.yesterday.day)
        end_local = self.local_now - timedelta(minutes=RECENT_WINDOW_LAG_MINUTES)
        if mode == "as_written":
            return start_local, end_local
        if mode == "previous_local_day":
            return self.utc_of_local(start_local), self.instant - timedelta(minutes=RECENT_WINDOW_LAG_MINUTES)
        raise ValueError(f"unknown window mode {mode!r}")

    # --- labels stamped on mart rows ---------------------------------------
    @property
    def year_label(self) -> str:
        return f"{self.today.year:04d}"

    @property
    def year_month_label(self) -> str:
        return f"{self.today.year:04d}-{self.today.month:02d}"

    def shifted(self, **delta) -> "AsOf":
        return AsOf(self.instant + timedelta(**delta), self.zone, self.region)


# The clock the registered queries and the oracle SQL use: the 21:00 UTC
# schedule on 2024-01-29, i.e. 06:00 on 2024-01-30 in the default zone.
DEFAULT_ASOF = AsOf(datetime(2024, 1, 29, 21, 0, 0))

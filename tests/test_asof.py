"""The clock and the range rewrites of the month filters."""

from datetime import date, datetime, timedelta, timezone

from hypothesis import given, settings
from hypothesis import strategies as st

from costbook.asof import DEFAULT_ASOF, AsOf


def _trunc_month(d: date) -> date:
    return d.replace(day=1)


def _month_sub(d: date) -> date:
    """DATE_SUB(d, INTERVAL 1 MONTH), day clamped to the month's end."""
    y, m = (d.year, d.month - 1) if d.month > 1 else (d.year - 1, 12)
    for day in (d.day, 30, 29, 28):
        try:
            return date(y, m, day)
        except ValueError:
            continue
    raise AssertionError


def test_default_clock():
    a = DEFAULT_ASOF
    assert a.local_now == datetime(2024, 1, 30, 6, 0)
    assert a.today == date(2024, 1, 30)
    assert a.month_window_utc() == (datetime(2023, 12, 31, 15), datetime(2024, 1, 31, 15))
    assert a.month_window_utc(1) == (datetime(2023, 11, 30, 15), datetime(2024, 1, 31, 15))
    assert a.recent_window() == (datetime(2024, 1, 29), datetime(2024, 1, 30, 5, 55))
    assert a.year_label == "2024" and a.year_month_label == "2024-01"


@settings(max_examples=300, deadline=None)
@given(today=st.dates(date(2000, 1, 1), date(2099, 12, 31)), delta=st.integers(-80, 80))
def test_current_month_filter_is_a_range(today, delta):
    """``DATE_TRUNC(d, MONTH) BETWEEN DATE_SUB(m0, 1 DAY) AND today`` == ``m0 <= d < m1``."""
    a = AsOf(datetime(today.year, today.month, today.day, 3))  # 03:00 UTC is 12:00 the same day in Tokyo
    d = today + timedelta(days=delta)
    m0 = _trunc_month(today)
    written = m0 - timedelta(days=1) <= _trunc_month(d) <= today
    assert written == (a.month_start(0) <= d < a.month_start(1))


@settings(max_examples=300, deadline=None)
@given(today=st.dates(date(2000, 1, 1), date(2099, 12, 31)), delta=st.integers(-100, 80))
def test_two_month_filter_is_a_range(today, delta):
    a = AsOf(datetime(today.year, today.month, today.day, 3))
    d = today + timedelta(days=delta)
    written = _trunc_month(_month_sub(today)) <= _trunc_month(d) <= today
    assert written == (a.month_start(-1) <= d < a.month_start(1))


def test_recent_window_corrected():
    a = DEFAULT_ASOF
    assert a.recent_window("previous_local_day") == (datetime(2024, 1, 28, 15), datetime(2024, 1, 29, 20, 55))


# --- zones other than the default: local dates and the range rewrite in Spark ------------------
import pytest  # noqa: E402
from zoneinfo import ZoneInfo  # noqa: E402

ZONES = ["Asia/Tokyo", "America/New_York", "Europe/Berlin", "Asia/Kolkata", "Australia/Lord_Howe"]


@pytest.mark.parametrize("zone", ZONES)
@settings(max_examples=3, deadline=None)
@given(seconds=st.lists(st.integers(0, 3 * 366 * 86400), min_size=50, max_size=200),
       asof_seconds=st.integers(0, 3 * 366 * 86400))
def test_local_date_and_month_range_in_spark(spark, zone, seconds, asof_seconds):
    from pyspark.sql import functions as F

    from costbook.functions import in_range, local_date

    base = datetime(2023, 1, 1)
    a = AsOf(base + timedelta(seconds=asof_seconds), zone)
    lo, hi = a.month_window_utc(0)
    one = timedelta(seconds=1)
    instants = [base + timedelta(seconds=s) for s in seconds] + [lo - one, lo, hi - one, hi]
    df = spark.createDataFrame([(t,) for t in instants], "ts timestamp_ntz")
    rows = df.select("ts", local_date("ts", zone).alias("d"), in_range("ts", lo, hi).alias("r")).collect()
    for r in rows:
        expected = r["ts"].replace(tzinfo=timezone.utc).astimezone(ZoneInfo(zone)).date()
        assert r["d"] == expected
        assert r["r"] == (a.month_start(0) <= expected < a.month_start(1))


def test_clock_across_the_year_boundary():
    a = AsOf.parse("2023-12-31T20:00:00")  # 05:00 on 2024-01-01 in Tokyo
    assert a.today == date(2024, 1, 1) and a.yesterday == date(2023, 12, 31)
    assert (a.year_label, a.year_month_label) == ("2024", "2024-01")
    assert a.month_start(-1) == date(2023, 12, 1) and a.month_start(1) == date(2024, 2, 1)
    assert a.month_window_utc() == (datetime(2023, 12, 31, 15), datetime(2024, 1, 31, 15))
    assert a.month_window_utc(1) == (datetime(2023, 11, 30, 15), datetime(2024, 1, 31, 15))
    assert a.recent_window() == (datetime(2023, 12, 31), datetime(2024, 1, 1, 4, 55))
    assert a.shifted(days=1).today == date(2024, 1, 2)

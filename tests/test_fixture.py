"""The fixture makes every window, option and merge branch do something (on the oracle SQL)."""

import duckdb
import pytest

from conftest import SF_SMALL
from costbook.plans.oracle import statements


@pytest.fixture(scope="module")
def run():
    con = duckdb.connect()
    for name in ("events", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_SMALL}/{name}.parquet'")
    sql = statements()
    return lambda key: sorted(map(str, con.execute(sql[key]).fetchall()))


@pytest.mark.parametrize("a,b", [
    ("editions_months_back", "edition_day_cost"), ("ondemand_latest_per_key", "ondemand_partial_revision"),
    ("slot_analysis_all_timeline_states", "slot_analysis"), ("upsert_ondemand", "ondemand_day_cost"),
    ("upsert_monthly_storage", "storage_month_price"), ("upsert_editions", "edition_day_cost"),
    ("editions_latest_per_key", "edition_day_cost"), ("editions_match_reservation", "edition_day_cost"),
    ("storage_explicit_logical", "storage_project_usage"), ("query_analysis_local_day", "query_analysis"),
])
def test_pairs_differ(run, a, b):
    assert run(a) != run(b)


@pytest.mark.parametrize("few,many", [("filter_month_window", "scan_jobs_timeline"), ("filter_two_month_window", "scan_jobs"),
                                      ("filter_recent_window", "scan_jobs")])
def test_windows_drop_rows(run, few, many):
    assert 0 < len(run(few)) < len(run(many))


def test_history_reaches_beyond_the_month_and_yesterday(run):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_SMALL}/events.parquet'")
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{SF_SMALL}/lineitem.parquet'")
    days = con.execute(f"SELECT count(DISTINCT date) FROM ({statements()['storage_analysis']})").fetchall()
    assert days == [(3,)]

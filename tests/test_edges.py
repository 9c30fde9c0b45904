"""Hand-written rows for behaviours the generated data cannot reach."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from costbook import schemas
from costbook.asof import DEFAULT_ASOF as A
from costbook.functions import admin_project
from costbook.operators import editions, jobs, ondemand, slots, storage
from costbook.operators.prices import compute_price, edition_price, storage_prices
from costbook.plans import pipelines
from helpers import frame, job, period, telemetry

RID = "adm:asia-northeast1.r1"


def test_admin_project_parsing(spark):
    df = spark.createDataFrame([("example.com:proj:loc.name",), ("adm:loc.r",), ("no-colon",), (None,)], "r string")
    got = [r[0] for r in df.select(admin_project("r")).collect()]
    assert got == ["example.comproj", "adm", None, None]


def test_reservation_without_project_fails(spark):
    ids = spark.createDataFrame([("no-colon",)], "reservation_id string")
    rt = frame(spark, schemas.RESERVATION_TIMELINE, [("x", 1, "x:l.r", 0, datetime(2024, 1, 29))])
    res = frame(spark, schemas.RESERVATIONS, [("x", 1, "STANDARD")])
    with pytest.raises(Exception, match="administration project"):
        editions.reservation_minutes(ids, rt, res).collect()


def _edition_inputs(spark, baseline, n_rows, ms, minute=datetime(2024, 1, 29, 10, 0)):
    tl = [period(job_id=f"j{i}", reservation=RID, created=minute, start=minute.replace(second=i % 60), ms=ms)
          for i in range(n_rows)]
    t = telemetry(spark, timeline=tl, rt=[("adm", 7, RID, baseline, minute)], res=[("adm", 7, "ENTERPRISE")])
    job_df = editions.edition_jobs(t.jobs_timeline, A)
    ids = job_df.select("reservation_id").distinct()
    res = editions.reservation_minutes(ids, t.reservation_timeline, t.reservations)
    return t, editions.edition_slot_minute(editions.minute_totals(job_df), res)


def test_baseline_subtracted_per_row_gives_negative_minute(spark):
    # 61 periods of one slot-second each, baseline 100: (61 - 61*100)/60/100 -> ceil(-1.0065) = -1
    _, m = _edition_inputs(spark, baseline=100, n_rows=61, ms=1000)
    assert [r["slot_sec_minute"] for r in m.collect()] == [-100]


def test_no_baseline_rounds_up_to_hundreds(spark):
    _, m = _edition_inputs(spark, baseline=0, n_rows=2, ms=3_000)
    assert [r["slot_sec_minute"] for r in m.collect()] == [100]


def test_division_order_keeps_scripts_result(spark):
    minutes = spark.createDataFrame(
        [("p", "j", "u", "r", datetime(2024, 1, 29, 10, i), 100, 100) for i in range(60)]
        + [("p", "j", "u", "r", datetime(2024, 1, 29, 11, i), 100, 100) for i in range(15)],
        "project_id string, job_id string, user_email string, reservation_id string, "
        "period_minute timestamp_ntz, slot_sec_average_in_minute bigint, slot_sec_max_in_minute bigint")
    row = slots.slot_job_hours(minutes).collect()[0]
    assert row["optimistic_slot_hour"] == 125.01  # 7500/3600*60*100 = 12500.000000000002


def test_month_window_edges(spark):
    edge = [datetime(2023, 12, 31, 14, 59, 59), datetime(2023, 12, 31, 15), datetime(2024, 1, 31, 14, 59, 59),
            datetime(2024, 1, 31, 15)]
    t = telemetry(spark, timeline=[period(job_id=str(i), reservation=RID, created=ts, start=ts)
                                   for i, ts in enumerate(edge)])
    kept = {r["job_id"] for r in editions.filter_month_window(t.jobs_timeline, A).collect()}
    assert kept == {"1", "2"}
    t = telemetry(spark, jobs=[job(job_id=str(i), start=ts) for i, ts in enumerate(edge)])
    kept = {r["job_id"] for r in ondemand.filter_two_month_window(t.jobs, A).collect()}
    assert kept == {"0", "1", "2"}


def test_recent_window_edges(spark):
    edge = [datetime(2024, 1, 28, 23, 59, 59, 999999), datetime(2024, 1, 29), datetime(2024, 1, 30, 5, 55),
            datetime(2024, 1, 30, 5, 55, 1)]
    t = telemetry(spark, jobs=[job(job_id=str(i), start=ts) for i, ts in enumerate(edge)])
    kept = {r["job_id"] for r in jobs.filter_recent_window(t.jobs, "start_time", A).collect()}
    assert kept == {"1", "2"}


def test_null_end_time_bytes_and_cache(spark):
    t = telemetry(spark, jobs=[(
        "p", "j1", "u", None, datetime(2024, 1, 29, 12), datetime(2024, 1, 29, 12), None, None, None, "SELECT", "DONE")])
    r = pipelines.query_analysis_source(t, A).collect()[0]
    assert r["query_time"] is None and r["query_size"] is None and r["cache"] is None and r["query"] is None


def test_statement_type_null_kept_by_editions_dropped_by_ondemand(spark):
    ts = datetime(2024, 1, 29, 12)
    t = telemetry(spark, jobs=[job(job_id="a", statement=None), job(job_id="b", statement="SCRIPT"), job(job_id="c")],
                  timeline=[period(job_id="a", reservation=RID, statement=None, created=ts, start=ts),
                            period(job_id="b", reservation=RID, statement="SCRIPT", created=ts, start=ts)])
    assert editions.edition_jobs(t.jobs_timeline, A).count() == 1
    assert [r["job_id"] for r in ondemand.filter_ondemand_jobs(t.jobs).collect()] == ["c"]


def test_ondemand_jobs_have_no_slots(spark):
    ts = datetime(2024, 1, 29, 12)
    t = telemetry(spark, jobs=[job(job_id="a", reservation=None, start=ts)],
                  timeline=[period(job_id="a", reservation=None, created=ts, start=ts, ms=5000)])
    r = pipelines.slot_analysis_source(t, A).collect()[0]
    assert r["slot_min"] is None and r["slot_max"] is None


def test_project_timeline_repeats_per_reservation(spark):
    """Two reservation ids of one admin project bring its timeline twice."""
    m = datetime(2024, 1, 29, 10)
    r1, r2 = "adm:l.r1", "adm:l.r2"
    tl = [period(job_id="a", reservation=r1, created=m, start=m, ms=60_000 * 100),
          period(job_id="b", reservation=r2, created=m, start=m, ms=60_000 * 100)]
    t = telemetry(spark, timeline=tl, rt=[("adm", 7, r1, 0, m), ("adm", 7, r2, 0, m)],
                  res=[("adm", 7, "ENTERPRISE")])
    src = editions.editions_source(t.jobs_timeline, t.reservation_timeline, t.reservations, t.price_compute, A)
    dedup = editions.editions_source(t.jobs_timeline, t.reservation_timeline, t.reservations, t.price_compute, A,
                                     dedupe_projects=True)
    # one minute of 100 slots = 100/60 slot-hours -> 1.67; counted twice -> 3.34
    price = 0.0918
    assert sorted(r["cost"] for r in src.collect()) == [3.34 * price] * 2
    assert sorted(r["cost"] for r in dedup.collect()) == [1.67 * price] * 2


# --- prices -------------------------------------------------------------------------------
def _price(spark, rows, cls="on_demand", **kw):
    p = frame(spark, schemas.PRICE_COMPUTE, rows)
    return spark.range(1).select(compute_price(p, "asia-northeast1", cls, **kw).alias("p")).collect()[0]["p"]


def test_newest_revision_over_whole_table(spark):
    rows = [("on_demand", 6.0, "asia-northeast1", date(2023, 7, 1)), ("standard", 1.0, "asia-northeast1",
                                                                        date(2023, 7, 1)),
            ("standard", 2.0, "asia-northeast1", date(2024, 1, 1))]
    assert _price(spark, rows) is None  # revision of another class hides the on-demand price
    assert _price(spark, rows, latest_per_key=True) == 6.0
    rows_region = [("on_demand", 6.0, "asia-northeast1", date(2023, 7, 1)), ("on_demand", 5.0, "us", date(2024, 1, 1))]
    assert _price(spark, rows_region) is None
    assert _price(spark, rows_region, latest_per_key=True) == 6.0
    future = [("on_demand", 6.0, "asia-northeast1", date(2023, 7, 1)),
              ("on_demand", 9.0, "asia-northeast1", date(2099, 1, 1))]
    assert _price(spark, future) == 9.0  # a future revision applies at once


def test_two_prices_for_one_class_raise(spark):
    rows = [("on_demand", 6.0, "asia-northeast1", date(2024, 1, 1)), ("on_demand", 7.0, "asia-northeast1",
                                                                        date(2024, 1, 1))]
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        _price(spark, rows)


def test_edition_price_unknown_edition_is_null(spark):
    p = frame(spark, schemas.PRICE_COMPUTE, [("standard", 1.5, "asia-northeast1", date(2024, 1, 1))])
    df = spark.createDataFrame([("STANDARD",), ("standard",), ("OTHER",)], "e string")
    got = [r[0] for r in df.select(edition_price(p, F.col("e"), "asia-northeast1")).collect()]
    assert got == [1.5, None, None]


# --- storage --------------------------------------------------------------------------------
def _table(project, dataset, name, al=0, ll=0, ap=0, lp=0, tt=0, fs=0):
    return (project, dataset, name, al, ll, ap, lp, tt, fs)


def test_billing_model_classification(spark):
    g = 1024 ** 3
    t = telemetry(spark, storage=[_table("p", "none", "a", al=g, ap=2 * g), _table("p", "phys", "b", al=g, ap=2 * g),
                                  _table("p", "logi", "c", al=g, ap=2 * g)],
                  options=[("p", "phys", "storage_billing_model", "PHYSICAL"),
                           ("p", "logi", "storage_billing_model", "LOGICAL"),
                           ("p", "none", "other_option", "x")])
    r = pipelines.daily_storage_usage_source(t, A).collect()[0]
    assert (r["logic_active"], r["comp_active"]) == (1.0, 2.0)  # explicit LOGICAL counts nowhere
    r = pipelines.daily_storage_usage_source(t, A, explicit_logical=True).collect()[0]
    assert (r["logic_active"], r["comp_active"]) == (2.0, 2.0)


def test_day_diff_new_vanished_and_doubled(spark):
    g = 1024 ** 3
    cur = storage.storage_dataset(frame(spark, schemas.TABLE_STORAGE, [
        _table("p", "new", "t", al=g), _table("p", "kept", "t", al=3 * g), _table("p", "twice", "t", al=g)]))
    prev = spark.createDataFrame(
        [("p", "kept", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0), ("p", "gone", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0),
         ("p", "twice", 0.5, 0.0, 0.0, 0.0, 0.0, 0.0), ("p", "twice", 0.25, 0.0, 0.0, 0.0, 0.0, 0.0)],
        "project_id string, dataset_id string, logic_active double, logic_long_term double, comp_active double, "
        "comp_long_term double, comp_time_travel double, comp_fail_safe double")
    rows = storage.storage_day_diff(cur, prev).collect()
    got = sorted((r["dataset_id"], r["diff_logic_active"]) for r in rows)
    assert got == [("kept", 2.0), ("new", None), ("twice", 0.5), ("twice", 0.75)]


def test_compressed_active_is_net_of_time_travel_and_fail_safe(spark):
    g = 1024 ** 3
    df = storage.storage_dataset(frame(spark, schemas.TABLE_STORAGE, [_table("p", "d", "t", ap=10 * g, tt=g, fs=2 * g)]))
    r = df.collect()[0]
    assert r["active_compressed_gigabytes"] == 7.0 and r["time_travel_compressed_gigabytes"] == 1.0


def test_month_mean_over_stored_rows_and_null_price(spark):
    daily = frame(spark, schemas.DAILY_STORAGE_USAGE, [
        ("p", 10.0, 0.0, 0.0, 0.0, date(2024, 1, 2)), ("p", 20.0, 0.0, 0.0, 0.0, date(2024, 1, 9)),
        ("p", 99.0, 0.0, 0.0, 0.0, date(2023, 12, 31))])
    avg = storage.storage_month_avg(daily, A).collect()[0]
    assert avg["monthly_logic_active"] == 15.0  # two stored days, not the calendar
    prices = frame(spark, schemas.PRICE_STORAGE, [(0.02, None, 0.04, 0.02, "asia-northeast1", date(2024, 1, 1))])
    r = storage.storage_month_price(storage.storage_month_avg(daily, A), prices, A).collect()[0]
    assert r["logic_active_price"] == 15.0 * 0.02
    assert r["logic_long_term_price"] is None and r["logic_total_price"] is None and r["total_price"] is None
    assert r["comp_total_price"] == 0.0
    assert (r["year"], r["year_month"], r["year_month_beginning"]) == ("2024", "2024-01", date(2024, 1, 1))


def test_storage_prices_lookup(spark):
    p = frame(spark, schemas.PRICE_STORAGE, [(1.0, 2.0, 3.0, 4.0, "asia-northeast1", date(2024, 1, 1)),
                                             (9.0, 9.0, 9.0, 9.0, "asia-northeast1", date(2023, 1, 1))])
    cols = storage_prices(p, "asia-northeast1")
    r = spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).collect()[0].asDict()
    assert r == {"logic_active": 1.0, "logic_long_term": 2.0, "comp_active": 3.0, "comp_long_term": 4.0}


# --- opt-in corrections -------------------------------------------------------------------
def test_months_back_admits_jobs_created_last_month(spark):
    created = datetime(2023, 12, 31, 14, 0)  # 23:00 local on Dec 31
    running = datetime(2023, 12, 31, 15, 30)  # 00:30 local on Jan 1
    t = telemetry(spark, timeline=[period(job_id="late", reservation=RID, created=created, start=running)])
    assert editions.edition_jobs(t.jobs_timeline, A).count() == 0
    assert editions.edition_jobs(t.jobs_timeline, A, months_back=1).count() == 1


def test_previous_local_day_window(spark):
    starts = {"a": datetime(2024, 1, 28, 14, 59, 59), "b": datetime(2024, 1, 28, 15), "c": datetime(2024, 1, 29, 20, 55),
              "d": datetime(2024, 1, 29, 21), "e": datetime(2024, 1, 30, 5, 0)}
    t = telemetry(spark, jobs=[job(job_id=k, start=v) for k, v in starts.items()])
    as_written = {r["job_id"] for r in jobs.filter_recent_window(t.jobs, "start_time", A).collect()}
    local_day = {r["job_id"] for r in jobs.filter_recent_window(t.jobs, "start_time", A, "previous_local_day").collect()}
    assert as_written == {"c", "d", "e"}  # starts from 21:00 UTC on are future instants, yet counted
    assert local_day == {"b", "c"}


def test_timeline_states(spark):
    ts = datetime(2024, 1, 29, 12)
    t = telemetry(spark, jobs=[job(job_id="a", reservation=RID, start=ts)],
                  timeline=[period(job_id="a", reservation=RID, start=ts, ms=6_000_000, state="RUNNING"),
                            period(job_id="a", reservation=RID, start=ts.replace(second=1), ms=6_000_000,
                                   state="DONE")])
    done_only = pipelines.slot_analysis_source(t, A).collect()[0]
    every = pipelines.slot_analysis_source(t, A, timeline_states=None).collect()[0]
    # 6000 slot-seconds in the minute -> 100 -> 1.67 slot-hours; both periods -> 200 -> 3.34
    assert done_only["slot_min"] == 1.67 and every["slot_min"] == 3.34
    assert done_only["slot_max"] == 100.0 and every["slot_max"] == 100.0  # peak second 6000 either way: 6000/3600*60/100


def test_weighted_reservation_minutes_equal_repeated_rows(spark):
    m = datetime(2024, 1, 29, 10)
    rids = [f"adm:l.r{i}" for i in range(3)]
    ids = spark.createDataFrame([(r,) for r in rids], "reservation_id string")
    rt = frame(spark, schemas.RESERVATION_TIMELINE, [("adm", 7, r, 10 * i, m) for i, r in enumerate(rids)])
    res = frame(spark, schemas.RESERVATIONS, [("adm", 7, "ENTERPRISE"), ("adm", 7, "ENTERPRISE_PLUS")])
    repeated = editions.reservation_minutes(ids, rt, res)
    weighted = editions.reservation_minutes(ids, rt, res, weighted=True)
    assert repeated.count() == 3 * 2 * 3  # 3 reservations x 2 editions, the project's timeline 3 times
    assert weighted.count() == 3 * 2 and {r["copies"] for r in weighted.collect()} == {3}
    expanded = sorted(tuple(r)[:4] for r in weighted.collect() for _ in range(r["copies"]))
    assert expanded == sorted(tuple(r) for r in repeated.collect())


def test_match_reservation_gives_each_minute_its_own_edition(spark):
    m = datetime(2024, 1, 29, 10)
    ids = spark.createDataFrame([("adm:loc.ent",), ("adm:loc.plus",)], "reservation_id string")
    rt = frame(spark, schemas.RESERVATION_TIMELINE, [("adm", 7, "adm:loc.ent", 0, m), ("adm", 7, "adm:loc.plus", 0, m)])
    res = spark.createDataFrame([("adm", 7, "ENTERPRISE", "ent"), ("adm", 7, "ENTERPRISE_PLUS", "plus")],
                                "project_id string, project_number bigint, edition string, reservation_name string")
    as_written = editions.reservation_minutes(ids, rt, res, weighted=True).collect()
    matched = editions.reservation_minutes(ids, rt, res, weighted=True, match_reservation=True).collect()
    assert len(as_written) == 4  # every minute with both editions
    assert sorted((r["reservation_id"], r["edition"]) for r in matched) == [
        ("adm:loc.ent", "ENTERPRISE"), ("adm:loc.plus", "ENTERPRISE_PLUS")]
    with pytest.raises(ValueError, match="reservation_name"):
        editions.reservation_minutes(ids, rt, res.drop("reservation_name"), match_reservation=True)


def test_price_list_maintenance(spark, tmp_dir):
    from costbook.operators.prices import append_compute_prices, append_storage_prices

    path = f"{tmp_dir}/compute"
    append_compute_prices(frame(spark, schemas.PRICE_COMPUTE, [("on_demand", 6.0, "asia-northeast1",
                                                                date(2023, 7, 1))]), path)
    append_compute_prices(frame(spark, schemas.PRICE_COMPUTE, [("on_demand", 7.5, "asia-northeast1",
                                                                date(2024, 1, 1))]), path)
    prices = spark.read.schema(schemas.PRICE_COMPUTE).parquet(path)
    assert prices.count() == 2
    assert spark.range(1).select(compute_price(prices, "asia-northeast1", "on_demand")).collect()[0][0] == 7.5
    with pytest.raises(ValueError, match="lack columns"):
        append_storage_prices(spark.createDataFrame([(1.0,)], "active_logical_pricing double"), f"{tmp_dir}/s")


def test_baseline_cost_is_a_whole_day_and_only_on_days_with_jobs(spark):
    m = datetime(2024, 1, 29, 1, 0)  # 10:00 local on Jan 29
    t = telemetry(spark, timeline=[period(job_id="a", reservation=RID, created=m, start=m, ms=60_000)],
                  rt=[("adm", 7, RID, 50, m), ("adm", 7, RID, 50, datetime(2024, 1, 27, 1, 0))],
                  res=[("adm", 7, "STANDARD")])
    rows = editions.editions_source(t.jobs_timeline, t.reservation_timeline, t.reservations, t.price_compute,
                                    A).collect()
    assert [(r["date"], r["baseline_cost"]) for r in rows] == [(date(2024, 1, 29), 50 * 24 * 0.051)]


def test_project_without_reservation_rows_costs_null(spark):
    m = datetime(2024, 1, 29, 1, 0)
    t = telemetry(spark, timeline=[period(job_id="a", reservation=RID, created=m, start=m, ms=60_000)],
                  rt=[("adm", 7, RID, 50, m)], res=[("other", 8, "STANDARD")])
    rows = editions.editions_source(t.jobs_timeline, t.reservation_timeline, t.reservations, t.price_compute,
                                    A).collect()
    assert [(r["edition"], r["baseline_cost"], r["cost"]) for r in rows] == [(None, None, None)]

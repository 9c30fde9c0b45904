"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables at ``sf_dir`` (through the fixture mapping
of :mod:`costbook.sources.fixtures`) and runs at the fixed clock
``DEFAULT_ASOF``.  Sink queries write to fresh folders below the shared
scratch root and return what the mart holds afterwards.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costbook import schemas
from costbook.asof import DEFAULT_ASOF, AsOf
from costbook.functions import admin_project, date_lit
from costbook.functions.timecols import ntz
from costbook.operators import editions, jobs, ondemand, sinks, slots, storage
from costbook.operators.prices import append_compute_prices, append_storage_prices, edition_price, storage_prices
from costbook.plans import pipelines
from costbook.session import scratch_path
from costbook.sources import fixtures
from costbook.sources.fanin import PerProject, fan_in
from costbook.sources.telemetry import read_table

ASOF = DEFAULT_ASOF
# The earlier scheduled runs that seed the merge targets: 2023-12-15 and
# 2024-01-15, 21:00 UTC, on the telemetry known at those instants and the first
# price revision only.  The first one's oldest rows meet no later source row
# (kept), the second one's are updated, the rest is inserted.
SEED_ASOF = AsOf(datetime(2023, 12, 15, 21, 0, 0))
MID_ASOF = AsOf(datetime(2024, 1, 15, 21, 0, 0))
OLD_PRICES = fixtures.PRICE_REVISION_DATES[0]


def _t(spark: SparkSession, sf_dir: str, price_up_to=None):
    return fixtures.telemetry(spark, sf_dir, price_up_to)


def _seed_telemetry(spark: SparkSession, sf_dir: str, asof=SEED_ASOF):
    return fixtures.known_at(_t(spark, sf_dir, OLD_PRICES), asof.instant)


# --- sources -----------------------------------------------------------------------
def _exported(spark, sf_dir, name: str, day_partition: str | None = None, of: str | None = None):
    """Write one fixture table as an export below the scratch root, then read
    it back with the export reader (fixed schema, day partitions kept)."""
    root = scratch_path(spark, "export")
    df = getattr(_t(spark, sf_dir), name)
    if day_partition:
        df.withColumn(day_partition, F.to_date(of)).write.partitionBy(day_partition).parquet(f"{root}/{name}")
    else:
        df.write.parquet(f"{root}/{name}")
    return read_table(spark, root, name)


def scan_jobs(spark, sf_dir):
    return _exported(spark, sf_dir, "jobs", "creation_date", "creation_time").drop("creation_date")


def scan_jobs_timeline(spark, sf_dir):
    return _exported(spark, sf_dir, "jobs_timeline", "period_date", "period_start").drop("period_date")


def scan_job_text(spark, sf_dir):
    return _exported(spark, sf_dir, "job_text")


def scan_table_storage(spark, sf_dir):
    return _exported(spark, sf_dir, "table_storage")


def _edition_reservation_ids(t):
    return editions.edition_jobs(t.jobs_timeline, ASOF).select("reservation_id").distinct()


def reservation_minutes(spark, sf_dir):
    """The editions script's ``res`` table, whole (every minute of each project's timeline)."""
    t = _t(spark, sf_dir)
    return editions.reservation_minutes(_edition_reservation_ids(t), t.reservation_timeline, t.reservations)


def storage_billing_model(spark, sf_dir):
    return storage.billing_model(_t(spark, sf_dir).schema_options)


def price_compute_latest(spark, sf_dir):
    """Reservation minutes of the month with the newest price of their edition."""
    t = _t(spark, sf_dir)
    res = editions.reservation_minutes(_edition_reservation_ids(t), t.reservation_timeline, t.reservations,
                                       minute_range=ASOF.month_window_utc(0))
    return res.withColumn("price", edition_price(t.price_compute, F.col("edition"), ASOF.region))


def price_storage_latest(spark, sf_dir):
    """Project storage usage with the four newest storage prices."""
    t = _t(spark, sf_dir)
    usage = pipelines.daily_storage_usage_source(t, ASOF)
    p = storage_prices(t.price_storage, ASOF.region)
    return usage.select("project_id", "logic_active", "logic_long_term", "comp_active", "comp_long_term",
                        *[p[k].alias(f"{k}_pricing") for k in p])


def _seed_storage_analysis(spark, sf_dir) -> str:
    """A storage-analysis mart holding the runs of yesterday, on the tables of lineitem
    rows with ``l_linenumber > 1``, and of two days before, on those ``> 2``."""
    path = scratch_path(spark, "mart-storage-analysis")
    t = _t(spark, sf_dir)
    lineitem = fixtures.read_driver_table(spark, sf_dir, "lineitem")
    for days in (2, 1):
        then = t.with_(table_storage=fixtures.table_storage(lineitem.filter(F.col("l_linenumber") > days)))
        pipelines.run_storage_analysis(spark, then, ASOF.shifted(days=-days), path)
    return path


def storage_prev_day(spark, sf_dir):
    path = _seed_storage_analysis(spark, sf_dir)
    return storage.storage_prev_day(sinks.read(spark, sinks.STORAGE_ANALYSIS, path), ASOF)


def distinct_projects(spark, sf_dir):
    """Projects whose job text the query-analysis run gathers."""
    return jobs.recent_jobs(_t(spark, sf_dir).jobs, ASOF).select("project_id").distinct()


# --- sinks -------------------------------------------------------------------------
def append_daily(spark, sf_dir):
    """The daily storage run appended twice: a rerun duplicates rows."""
    path = scratch_path(spark, "mart-daily-storage")
    t = _t(spark, sf_dir)
    pipelines.run_daily_storage_usage(t, ASOF, path)
    pipelines.run_daily_storage_usage(t, ASOF, path)
    return sinks.read(spark, sinks.DAILY_STORAGE_USAGE, path)


def upsert_editions(spark, sf_dir):
    """December's run (old prices, every edition STANDARD), then today's run merged over
    it, on all reservations: December's rows stay, January's are inserted.  (A baseline
    that changes within a day repeats a key, and a MERGE that met such a key again
    would raise: updates are tested on the reservations without one.)"""
    path = scratch_path(spark, "mart-editions")
    t = _seed_telemetry(spark, sf_dir)
    before = t.with_(reservations=t.reservations.withColumn("edition", F.lit("STANDARD")))
    pipelines.run_editions_day_pricing(before, SEED_ASOF, path, match_reservation=True)
    pipelines.run_editions_day_pricing(_t(spark, sf_dir), ASOF, path, match_reservation=True)
    return sinks.read(spark, sinks.DAILY_EDITIONS_COMPUTE_PRICING, path)


def upsert_ondemand(spark, sf_dir):
    """December's run (old prices), then today's run merged over it: November's rows
    stay, December's are updated, January's are inserted."""
    path = scratch_path(spark, "mart-ondemand")
    pipelines.run_ondemand_day_pricing(_seed_telemetry(spark, sf_dir), SEED_ASOF, path)
    pipelines.run_ondemand_day_pricing(_t(spark, sf_dir), ASOF, path)
    return sinks.read(spark, sinks.DAILY_ONDEMAND_COMPUTE_PRICING, path)


def _daily_history_mart(spark, sf_dir, up_to=None) -> str:
    path = scratch_path(spark, "mart-daily-storage-history")
    hist = fixtures.daily_storage_history(fixtures.read_driver_table(spark, sf_dir, "events"))
    if up_to is not None:
        hist = hist.filter(F.col("date") <= date_lit(up_to))
    sinks.append(hist, sinks.DAILY_STORAGE_USAGE, path)
    return path


def upsert_monthly_storage(spark, sf_dir):
    """Month-to-date prices of December and of 2024-01-16 (old prices), then today's
    merged over them: December stays, January is updated."""
    path = scratch_path(spark, "mart-monthly-storage")
    for asof in (SEED_ASOF, MID_ASOF):
        seed_hist = _daily_history_mart(spark, sf_dir, up_to=asof.today)
        pipelines.run_monthly_storage_pricing(spark, _t(spark, sf_dir, OLD_PRICES), asof, seed_hist, path)
    hist = _daily_history_mart(spark, sf_dir)
    pipelines.run_monthly_storage_pricing(spark, _t(spark, sf_dir), ASOF, hist, path)
    return sinks.read(spark, sinks.MONTHLY_STORAGE_PRICING, path)


def price_revision_append(spark, sf_dir):
    """Append the 2024-01-01 revision to a price list holding the first one,
    then cost on-demand use with the result."""
    path = scratch_path(spark, "price-compute")
    append_compute_prices(fixtures.price_compute(spark, OLD_PRICES), path)
    revision = fixtures.price_compute(spark).filter(F.col("application_start_date") > date_lit(OLD_PRICES))
    append_compute_prices(revision, path)
    prices = spark.read.schema(schemas.PRICE_COMPUTE).parquet(path)
    return ondemand.ondemand_day_cost(_t(spark, sf_dir).jobs, prices, ASOF)


def price_revision_storage(spark, sf_dir):
    """Append the 2024-01-01 revision to a storage price list holding the first
    one, then price the month with the result."""
    path = scratch_path(spark, "price-storage")
    append_storage_prices(fixtures.price_storage(spark, OLD_PRICES), path)
    revision = fixtures.price_storage(spark).filter(F.col("application_start_date") > date_lit(OLD_PRICES))
    append_storage_prices(revision, path)
    t = _t(spark, sf_dir).with_(price_storage=spark.read.schema(schemas.PRICE_STORAGE).parquet(path))
    daily = pipelines.read_month(spark, _daily_history_mart(spark, sf_dir), ASOF)
    return pipelines.monthly_storage_pricing_source(daily, t, ASOF)


def create_mart(spark, sf_dir):
    """The slot-analysis mart created, created again (a no-op), filled, and read
    by the schema that it keeps."""
    path = scratch_path(spark, "mart-created")
    sinks.ensure(spark, sinks.SLOT_ANALYSIS, path)
    sinks.ensure(spark, sinks.SLOT_ANALYSIS, path)
    pipelines.run_slot_analysis(_t(spark, sf_dir), ASOF, path)
    return spark.read.schema(sinks.kept_schema(spark, path)).parquet(path)


# --- predicates and projections --------------------------------------------------------
def filter_month_window(spark, sf_dir):
    return editions.filter_month_window(_t(spark, sf_dir).jobs_timeline, ASOF)


def filter_two_month_window(spark, sf_dir):
    return ondemand.filter_two_month_window(_t(spark, sf_dir).jobs, ASOF)


def filter_recent_window(spark, sf_dir):
    return jobs.filter_recent_window(_t(spark, sf_dir).jobs, "start_time", ASOF)


def filter_reserved_jobs(spark, sf_dir):
    return editions.edition_jobs(_t(spark, sf_dir).jobs_timeline, ASOF)


def filter_ondemand_jobs(spark, sf_dir):
    return ondemand.filter_ondemand_jobs(ondemand.filter_two_month_window(_t(spark, sf_dir).jobs, ASOF))


def storage_classified(spark, sf_dir):
    t = _t(spark, sf_dir)
    return storage.storage_classified(t.table_storage, storage.billing_model(t.schema_options))


def storage_month_price(spark, sf_dir):
    daily = sinks.read(spark, sinks.DAILY_STORAGE_USAGE, _daily_history_mart(spark, sf_dir))
    return pipelines.monthly_storage_pricing_source(daily, _t(spark, sf_dir), ASOF)


def storage_day_diff(spark, sf_dir):
    path = _seed_storage_analysis(spark, sf_dir)
    prev = storage.storage_prev_day(sinks.read(spark, sinks.STORAGE_ANALYSIS, path), ASOF)
    return storage.storage_day_diff(storage.storage_dataset(_t(spark, sf_dir).table_storage), prev)


def job_seconds(spark, sf_dir):
    return jobs.job_seconds(_t(spark, sf_dir).jobs).select(
        "project_id", "job_id", "start_time", "end_time", "query_execution_seconds")


def reservation_admin_project(spark, sf_dir):
    j = _t(spark, sf_dir).jobs.filter(F.col("reservation_id").isNotNull())
    return j.select("job_id", "reservation_id", admin_project("reservation_id").alias("admin_project"))


# --- joins and aggregations ---------------------------------------------------------------
def _month_res(t, weighted=False):
    job = editions.edition_jobs(t.jobs_timeline, ASOF)
    ids = job.select("reservation_id").distinct()
    return job, editions.reservation_minutes(ids, t.reservation_timeline, t.reservations,
                                             minute_range=ASOF.month_window_utc(0), weighted=weighted)


def join_timeline_reservation(spark, sf_dir):
    job, res = _month_res(_t(spark, sf_dir))
    return editions.join_timeline_reservation(job, res)


def _edition_minutes(t):
    job, res = _month_res(t, weighted=True)
    return editions.edition_slot_minute(editions.minute_totals(job), res)


def edition_slot_minute(spark, sf_dir):
    m = _edition_minutes(_t(spark, sf_dir))
    return m.withColumn("slot_sec_minute", F.col("slot_sec_minute").cast("double"))


def edition_slot_hour(spark, sf_dir):
    h = editions.edition_slot_hour(_edition_minutes(_t(spark, sf_dir)))
    return h.select("reservation_id", "period_hour", "edition", "baseline",
                    (F.col("slot_hour_cents").cast("double") / 100.0).alias("slot_hour_optimistic"))


def edition_day_cost(spark, sf_dir):
    return pipelines.editions_day_pricing_source(_t(spark, sf_dir), ASOF)


def ondemand_day_cost(spark, sf_dir):
    return pipelines.ondemand_day_pricing_source(_t(spark, sf_dir), ASOF)


def storage_project_usage(spark, sf_dir):
    return pipelines.daily_storage_usage_source(_t(spark, sf_dir), ASOF)


def storage_month_avg(spark, sf_dir):
    daily = sinks.read(spark, sinks.DAILY_STORAGE_USAGE, _daily_history_mart(spark, sf_dir))
    return storage.storage_month_avg(daily, ASOF)


def job_billed(spark, sf_dir):
    return jobs.job_billed(jobs.recent_jobs(_t(spark, sf_dir).jobs, ASOF))


def _recent_tl(spark, sf_dir):
    return slots.recent_timeline(_t(spark, sf_dir).jobs_timeline, ASOF)


def slot_second(spark, sf_dir):
    s = slots.slot_second(_recent_tl(spark, sf_dir))
    return s.select("period_start", *slots.SLOT_KEYS, (F.col("slot_ms").cast("double") / 1000.0).alias("slot_sec"))


def slot_minute(spark, sf_dir):
    m = slots.slot_minute(slots.slot_second(_recent_tl(spark, sf_dir)))
    return m.select("period_minute", *slots.SLOT_KEYS,
                    F.col("slot_sec_average_in_minute").cast("double").alias("slot_sec_average_in_minute"),
                    F.col("slot_sec_max_in_minute").cast("double").alias("slot_sec_max_in_minute"))


def slot_job_hours(spark, sf_dir):
    return slots.slot_job_hours(slots.slot_minute(slots.slot_second(_recent_tl(spark, sf_dir))))


def storage_dataset(spark, sf_dir):
    return storage.storage_dataset(_t(spark, sf_dir).table_storage)


# --- fan-in --------------------------------------------------------------------------------
def fan_in_strict(spark, sf_dir):
    """Reservation timelines exported one folder per administration project,
    gathered for the projects the month's reserved jobs name; any missing
    folder fails the run."""
    t = _t(spark, sf_dir)
    root = scratch_path(spark, "reservation-timeline-by-project")
    # one folder per project; the files keep the project column, like a real export
    (t.reservation_timeline.withColumn("export_project", F.col("project_id"))
     .write.partitionBy("export_project").parquet(root))
    admins = _edition_reservation_ids(t).select(admin_project("reservation_id").alias("p")).distinct()
    keys = [r["p"] for r in admins.collect()]  # the key list only: a handful of project ids
    result = fan_in(spark, {k: f"{root}/export_project={k}" for k in keys},
                    schemas.RESERVATION_TIMELINE, on_error="raise")
    return result.frame


def fan_in_skip(spark, sf_dir):
    """Schema options exported one folder per project, gathered for every
    project of the storage snapshot; unreadable (here: absent) ones are skipped."""
    t = _t(spark, sf_dir)
    root = scratch_path(spark, "schema-options-by-project")
    (t.schema_options.withColumn("export_project", F.col("catalog_name"))
     .write.partitionBy("export_project").parquet(root))
    projects = [r["project_id"] for r in t.table_storage.select("project_id").distinct().collect()]
    result = fan_in(spark, {p: f"{root}/export_project={p}" for p in projects}, schemas.SCHEMA_OPTIONS,
                    on_error="skip")
    return storage.billing_model(result.frame)


# --- whole pipelines, on sources exported one folder per project ------------------------------
_PROJECT_COLUMN = {"reservation_timeline": "project_id", "reservations": "project_id", "job_text": "project_id",
                   "schema_options": "catalog_name"}


def _by_project(spark, sf_dir, *names):
    """The telemetry with the named sources written one folder per project."""
    t = _t(spark, sf_dir)
    sources = {}
    for name in names:
        root = scratch_path(spark, f"{name}-by-project")
        rows = getattr(t, name)
        rows.withColumn("export_project", F.col(_PROJECT_COLUMN[name])).write.partitionBy("export_project").parquet(root)
        sources[name] = PerProject(spark, root + "/export_project={key}", rows.schema)
    return t.with_(**sources)


def editions_day_pricing(spark, sf_dir):
    path = scratch_path(spark, "mart-editions")
    pipelines.run_editions_day_pricing(_by_project(spark, sf_dir, "reservation_timeline", "reservations"), ASOF, path)
    return sinks.read(spark, sinks.DAILY_EDITIONS_COMPUTE_PRICING, path)


def ondemand_day_pricing(spark, sf_dir):
    path = scratch_path(spark, "mart-ondemand")
    pipelines.run_ondemand_day_pricing(_t(spark, sf_dir), ASOF, path)
    return sinks.read(spark, sinks.DAILY_ONDEMAND_COMPUTE_PRICING, path)


def daily_storage_usage(spark, sf_dir):
    """A project without options (here proj-6) is skipped: its tables count as logical."""
    path = scratch_path(spark, "mart-daily-storage")
    pipelines.run_daily_storage_usage(_by_project(spark, sf_dir, "schema_options"), ASOF, path)
    return sinks.read(spark, sinks.DAILY_STORAGE_USAGE, path)


def monthly_storage_pricing(spark, sf_dir):
    path = scratch_path(spark, "mart-monthly-storage")
    pipelines.run_monthly_storage_pricing(spark, _t(spark, sf_dir), ASOF, _daily_history_mart(spark, sf_dir), path)
    return sinks.read(spark, sinks.MONTHLY_STORAGE_PRICING, path)


def query_analysis(spark, sf_dir):
    path = scratch_path(spark, "mart-query-analysis")
    pipelines.run_query_analysis(_by_project(spark, sf_dir, "job_text"), ASOF, path)
    return sinks.read(spark, sinks.QUERY_ANALYSIS, path)


def slot_analysis(spark, sf_dir):
    path = scratch_path(spark, "mart-slot-analysis")
    pipelines.run_slot_analysis(_by_project(spark, sf_dir, "job_text"), ASOF, path)
    return sinks.read(spark, sinks.SLOT_ANALYSIS, path)


def storage_analysis(spark, sf_dir):
    """The two days before (seeded), then today's run appended: the mart holds three days."""
    path = _seed_storage_analysis(spark, sf_dir)
    pipelines.run_storage_analysis(spark, _by_project(spark, sf_dir, "schema_options"), ASOF, path)
    return sinks.read(spark, sinks.STORAGE_ANALYSIS, path)


# --- opt-in corrections of the scripts' behaviour ----------------------------------------------
def editions_months_back(spark, sf_dir):
    """Also cost jobs created last month whose periods run this month."""
    return pipelines.editions_day_pricing_source(_t(spark, sf_dir), ASOF, months_back=1)


def editions_dedupe_projects(spark, sf_dir):
    """Take each administration project's reservation timeline once."""
    return pipelines.editions_day_pricing_source(_t(spark, sf_dir), ASOF, dedupe_projects=True)


def editions_match_reservation(spark, sf_dir):
    """Give each reservation's minutes its own edition only (match by name too)."""
    return pipelines.editions_day_pricing_source(_t(spark, sf_dir), ASOF, match_reservation=True)


def ondemand_latest_per_key(spark, sf_dir):
    """Newest price per class and region, not over the whole price list, whose last
    revision covers one class only."""
    t = fixtures.with_partial_revision(_t(spark, sf_dir))
    return pipelines.ondemand_day_pricing_source(t, ASOF, latest_per_key=True)


def ondemand_partial_revision(spark, sf_dir):
    """As written, a revision that covers one class makes the other prices NULL."""
    return pipelines.ondemand_day_pricing_source(fixtures.with_partial_revision(_t(spark, sf_dir)), ASOF)


def editions_latest_per_key(spark, sf_dir):
    t = fixtures.with_partial_revision(_t(spark, sf_dir))
    return pipelines.editions_day_pricing_source(t, ASOF, latest_per_key=True)


def monthly_storage_latest_per_key(spark, sf_dir):
    t = fixtures.with_partial_revision(_t(spark, sf_dir))
    daily = pipelines.read_month(spark, _daily_history_mart(spark, sf_dir), ASOF)
    return pipelines.monthly_storage_pricing_source(daily, t, ASOF, latest_per_key=True)


def storage_explicit_logical(spark, sf_dir):
    """An explicit LOGICAL billing model counts as logical storage."""
    return pipelines.daily_storage_usage_source(_t(spark, sf_dir), ASOF, explicit_logical=True)


def daily_storage_replace_partition(spark, sf_dir):
    """The daily storage run twice with partition replacement: no duplicates."""
    path = scratch_path(spark, "mart-daily-storage")
    t = _t(spark, sf_dir)
    pipelines.run_daily_storage_usage(t, ASOF, path, replace_partition=True)
    pipelines.run_daily_storage_usage(t, ASOF, path, replace_partition=True)
    return sinks.read(spark, sinks.DAILY_STORAGE_USAGE, path)


def query_analysis_local_day(spark, sf_dir):
    """Jobs started from the previous local midnight to five minutes ago."""
    return pipelines.query_analysis_source(_t(spark, sf_dir), ASOF, window="previous_local_day")


def slot_analysis_local_day(spark, sf_dir):
    return pipelines.slot_analysis_source(_t(spark, sf_dir), ASOF, window="previous_local_day")


def slot_analysis_all_timeline_states(spark, sf_dir):
    """Timeline periods of every state count towards a finished job's slots."""
    return pipelines.slot_analysis_source(_t(spark, sf_dir), ASOF, timeline_states=None)


# --- month to date from partial sums per day ----------------------------------------------------
def _by_day(rows, column: str, path: str, part: str) -> None:
    rows.withColumn(part, F.to_date(column)).write.partitionBy(part).mode("append").parquet(path)


def _grown_export(spark, sf_dir, first_run):
    """An export laid out by day: with the rows known in mid-January (on which ``first_run``
    is called), then with the rest added to it."""
    t, root = _t(spark, sf_dir), scratch_path(spark, "export-by-day")
    known = fixtures.known_at(t, MID_ASOF.instant)
    for name in ("reservations", "price_compute"):
        getattr(t, name).write.parquet(f"{root}/{name}")
    _by_day(t.reservation_timeline, "period_start", f"{root}/reservation_timeline", "period_date")
    _by_day(known.jobs, "creation_time", f"{root}/jobs", "creation_date")
    _by_day(known.jobs_timeline, "period_start", f"{root}/jobs_timeline", "period_date")
    first_run(root)
    _by_day(t.jobs.filter(F.col("creation_time") > ntz(MID_ASOF.instant)), "creation_time", f"{root}/jobs", "creation_date")
    _by_day(t.jobs_timeline.filter(F.col("period_start") > ntz(MID_ASOF.instant)), "period_start", f"{root}/jobs_timeline", "period_date")
    return root


def editions_incremental(spark, sf_dir):
    """Mid-January's run, then today's from the days that changed since: the rows of a full run."""
    kept, path = scratch_path(spark, "kept-editions"), scratch_path(spark, "mart-editions")
    root = _grown_export(spark, sf_dir, lambda root: pipelines.run_editions_day_pricing_kept(
        spark, root, MID_ASOF, scratch_path(spark, "mart-editions"), kept))
    pipelines.run_editions_day_pricing_kept(spark, root, ASOF, path, kept)
    return sinks.read(spark, sinks.DAILY_EDITIONS_COMPUTE_PRICING, path)


def ondemand_incremental(spark, sf_dir):
    """The same for on-demand cost, merged over the earlier run's rows."""
    kept, path = scratch_path(spark, "kept-ondemand"), scratch_path(spark, "mart-ondemand")
    root = _grown_export(spark, sf_dir, lambda root: pipelines.run_ondemand_day_pricing_kept(spark, root, MID_ASOF, path, kept))
    pipelines.run_ondemand_day_pricing_kept(spark, root, ASOF, path, kept)
    return sinks.read(spark, sinks.DAILY_ONDEMAND_COMPUTE_PRICING, path)


def _fresh(name):
    return lambda spark, sf_dir: (_t(spark, sf_dir), scratch_path(spark, f"mart-{name}"))


def _run(pipeline, mart):
    def body(spark, state):
        t, path = state
        pipeline(t, ASOF, path)
        return sinks.read(spark, mart, path)

    return body


def _run_monthly(spark, state):
    (t, path), daily = state
    pipelines.run_monthly_storage_pricing(spark, t, ASOF, daily, path)
    return sinks.read(spark, sinks.MONTHLY_STORAGE_PRICING, path)


def _run_storage_analysis(spark, state):
    t, path = state
    pipelines.run_storage_analysis(spark, t, ASOF, path)
    return sinks.read(spark, sinks.STORAGE_ANALYSIS, path)


def _run_upsert_ondemand(spark, state):
    t, path = state
    pipelines.run_ondemand_day_pricing(t, ASOF, path)
    return sinks.read(spark, sinks.DAILY_ONDEMAND_COMPUTE_PRICING, path)


def _seeded_ondemand(spark, sf_dir):
    path = scratch_path(spark, "mart-ondemand")
    pipelines.run_ondemand_day_pricing(_seed_telemetry(spark, sf_dir), SEED_ASOF, path)
    return _t(spark, sf_dir), path


# The pipelines as the bench times them: (prepare, run).  Preparing (seeding a
# mart, writing a source one folder per project) is fixture work and not timed.
TIMED = {
    "editions_day_pricing": (_fresh("editions"), _run(pipelines.run_editions_day_pricing, sinks.DAILY_EDITIONS_COMPUTE_PRICING)),
    "ondemand_day_pricing": (_fresh("ondemand"), _run(pipelines.run_ondemand_day_pricing, sinks.DAILY_ONDEMAND_COMPUTE_PRICING)),
    "daily_storage_usage": (_fresh("daily"), _run(pipelines.run_daily_storage_usage, sinks.DAILY_STORAGE_USAGE)),
    "query_analysis": (_fresh("query"), _run(pipelines.run_query_analysis, sinks.QUERY_ANALYSIS)),
    "slot_analysis": (_fresh("slot"), _run(pipelines.run_slot_analysis, sinks.SLOT_ANALYSIS)),
    "storage_analysis": (lambda spark, sf_dir: (_t(spark, sf_dir), _seed_storage_analysis(spark, sf_dir)),
                         _run_storage_analysis),
    "monthly_storage_pricing": (lambda spark, sf_dir: (_fresh("monthly")(spark, sf_dir), _daily_history_mart(spark, sf_dir)),
                                _run_monthly),
    "upsert_ondemand": (_seeded_ondemand, _run_upsert_ondemand),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in list(globals().items())
    if callable(fn) and not name.startswith("_") and getattr(fn, "__module__", None) == __name__
}

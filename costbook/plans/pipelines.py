"""The seven scheduled pipelines, each as "build source DataFrame, then sink".

``*_source`` functions return the DataFrame a run writes; they write no mart
(the editions and query-analysis sources stage a table below the scratch root,
and the storage-analysis source creates its mart if absent so that yesterday's
partition can be read).  ``run_*`` functions write the mart at ``path``.
Options that correct a behaviour of the scheduled scripts are keyword
arguments, off by default.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from costbook.asof import AsOf
from costbook.constants import FINISHED_STATE
from costbook import schemas
from costbook.operators import partials, sinks
from costbook.operators.editions import edition_cost_of_partials, edition_minute_partials, editions_source
from costbook.operators.jobs import query_analysis_rows, recent_jobs
from costbook.operators.ondemand import ondemand_cost_of_partials, ondemand_day_cost, ondemand_day_partials
from costbook.operators.slots import slot_analysis_rows
from costbook.operators.storage import (
    billing_model,
    storage_analysis_rows,
    storage_month_avg,
    storage_month_price,
    storage_prev_day,
    storage_project_usage,
)
from costbook.session import Staging, require_utc
from costbook.sources.fanin import gather
from costbook.sources.telemetry import Telemetry, read_table


# --- P1 -------------------------------------------------------------------------
def editions_day_pricing_source(t: Telemetry, asof: AsOf, **opts) -> DataFrame:
    return editions_source(t.jobs_timeline, t.reservation_timeline, t.reservations, t.price_compute, asof, **opts)


def run_editions_day_pricing(t: Telemetry, asof: AsOf, path: str, **opts) -> None:
    require_utc(t.spark)
    with Staging(t.spark) as staging:
        sinks.upsert(editions_day_pricing_source(t, asof, staging=staging, **opts),
                     sinks.DAILY_EDITIONS_COMPUTE_PRICING, path)


# --- P2 -------------------------------------------------------------------------
def ondemand_day_pricing_source(t: Telemetry, asof: AsOf, latest_per_key: bool = False) -> DataFrame:
    return ondemand_day_cost(t.jobs, t.price_compute, asof, latest_per_key)


def run_ondemand_day_pricing(t: Telemetry, asof: AsOf, path: str, **opts) -> None:
    require_utc(t.spark)
    sinks.upsert(ondemand_day_pricing_source(t, asof, **opts), sinks.DAILY_ONDEMAND_COMPUTE_PRICING, path)


# --- P1 and P2 from partial sums per day -------------------------------------------
def run_editions_day_pricing_kept(spark: SparkSession, root: str, asof: AsOf, path: str, kept: str, months_back: int = 0,
                                  dedupe_projects: bool = False, latest_per_key: bool = False,
                                  match_reservation: bool = False) -> list[date]:
    """:func:`run_editions_day_pricing` for an export at ``root`` that is laid out by
    ``period_date``; the partial sums at ``kept`` are recomputed for the days whose input
    changed (returned), and the mart gets the rows of a full run."""
    require_utc(spark)
    window = asof.month_window_utc(0)
    days = partials.DayExport(spark, root, {"jobs_timeline": "period_start", "reservation_timeline": "period_start"}, window)
    reservations = read_table(spark, root, "reservations")
    depends = f"{asof.month_window_utc(months_back)} {window} {match_reservation} {partials.rows_digest(reservations)}"
    sums = partials.KeptDays(spark, kept, schemas.EDITION_MINUTE_PARTIAL)
    changed = sums.refresh(days.prints(depends), lambda some: edition_minute_partials(
        days.read("jobs_timeline", some), days.read("reservation_timeline", some), reservations, asof, months_back, match_reservation))
    rows = edition_cost_of_partials(sums.read(days.days), read_table(spark, root, "price_compute"), asof, dedupe_projects, latest_per_key)
    sinks.upsert(rows, sinks.DAILY_EDITIONS_COMPUTE_PRICING, path)
    return changed


def run_ondemand_day_pricing_kept(spark: SparkSession, root: str, asof: AsOf, path: str, kept: str,
                                  latest_per_key: bool = False) -> list[date]:
    """:func:`run_ondemand_day_pricing` for an export at ``root`` whose jobs are laid out by
    ``creation_date``, in the same way."""
    require_utc(spark)
    days = partials.DayExport(spark, root, {"jobs": "creation_time"}, asof.month_window_utc(1))
    sums = partials.KeptDays(spark, kept, schemas.ONDEMAND_DAY_PARTIAL)
    changed = sums.refresh(days.prints(asof.zone), lambda some: ondemand_day_partials(days.read("jobs", some), "creation_date", asof.zone))
    prices = read_table(spark, root, "price_compute")
    sinks.upsert(ondemand_cost_of_partials(sums.read(days.days), prices, asof, latest_per_key), sinks.DAILY_ONDEMAND_COMPUTE_PRICING, path)
    return changed


# --- P3 -------------------------------------------------------------------------
def _options(t: Telemetry) -> tuple[DataFrame, dict[str, str]]:
    """The schema options of the snapshot's projects; unreadable projects are left out and named."""
    return gather(t.schema_options, t.table_storage, "project_id", "skip")


def daily_storage_usage_source(t: Telemetry, asof: AsOf, explicit_logical: bool = False) -> DataFrame:
    return storage_project_usage(t.table_storage, billing_model(_options(t)[0]), asof, explicit_logical)


def run_daily_storage_usage(t: Telemetry, asof: AsOf, path: str, replace_partition: bool = False,
                            explicit_logical: bool = False) -> dict[str, str]:
    """Returns the projects whose options were skipped, and why."""
    require_utc(t.spark)
    options, skipped = _options(t)
    rows = storage_project_usage(t.table_storage, billing_model(options), asof, explicit_logical)
    sinks.append(rows, sinks.DAILY_STORAGE_USAGE, path, replace_partition)
    return skipped


# --- P4 -------------------------------------------------------------------------
def monthly_storage_pricing_source(daily_usage: DataFrame, t: Telemetry, asof: AsOf,
                                   latest_per_key: bool = False) -> DataFrame:
    return storage_month_price(storage_month_avg(daily_usage, asof), t.price_storage, asof, latest_per_key)


def read_month(spark: SparkSession, path: str, asof: AsOf) -> DataFrame:
    """The daily storage mart's partitions of the current month, and no others."""
    days = (asof.month_start(1) - asof.month_start(0)).days
    return sinks.read(spark, sinks.DAILY_STORAGE_USAGE, path,
                      [asof.month_start(0) + timedelta(days=k) for k in range(days)])


def run_monthly_storage_pricing(spark: SparkSession, t: Telemetry, asof: AsOf, daily_usage_path: str, path: str,
                                **opts) -> None:
    require_utc(spark)
    daily = read_month(spark, daily_usage_path, asof)
    sinks.upsert(monthly_storage_pricing_source(daily, t, asof, **opts), sinks.MONTHLY_STORAGE_PRICING, path)


# --- P5 -------------------------------------------------------------------------
def _text(t: Telemetry, asof: AsOf, window: str, states) -> DataFrame:
    """The job text of the projects with recent jobs; a missing or unreadable one stops the run."""
    if isinstance(t.job_text, DataFrame):
        return t.job_text
    return gather(t.job_text, recent_jobs(t.jobs, asof, window, states), "project_id", "raise")[0]


def query_analysis_source(t: Telemetry, asof: AsOf, window: str = "as_written", states=(FINISHED_STATE,),
                          staging: Staging | None = None) -> DataFrame:
    return query_analysis_rows(t.jobs, _text(t, asof, window, states), asof, window, states, staging)


def run_query_analysis(t: Telemetry, asof: AsOf, path: str, replace_partition: bool = False, **opts) -> None:
    require_utc(t.spark)
    with Staging(t.spark) as staging:
        rows = query_analysis_source(t, asof, staging=staging, **opts)
        sinks.append(rows, sinks.QUERY_ANALYSIS, path, replace_partition)


# --- P6 -------------------------------------------------------------------------
def slot_analysis_source(t: Telemetry, asof: AsOf, window: str = "as_written", states=(FINISHED_STATE,),
                         timeline_states=(FINISHED_STATE,)) -> DataFrame:
    text = _text(t, asof, window, states)
    return slot_analysis_rows(t.jobs, t.jobs_timeline, text, asof, window, states, timeline_states)


def run_slot_analysis(t: Telemetry, asof: AsOf, path: str, replace_partition: bool = False, **opts) -> None:
    require_utc(t.spark)
    sinks.append(slot_analysis_source(t, asof, **opts), sinks.SLOT_ANALYSIS, path, replace_partition)


# --- P7 -------------------------------------------------------------------------
def _storage_analysis(spark: SparkSession, t: Telemetry, asof: AsOf, path: str) -> tuple[DataFrame, dict[str, str]]:
    sinks.ensure(spark, sinks.STORAGE_ANALYSIS, path)
    yesterday = sinks.read(spark, sinks.STORAGE_ANALYSIS, path, [asof.yesterday])
    options, skipped = _options(t)
    return storage_analysis_rows(t.table_storage, billing_model(options), storage_prev_day(yesterday, asof), asof), skipped


def storage_analysis_source(spark: SparkSession, t: Telemetry, asof: AsOf, path: str) -> DataFrame:
    """Reads yesterday's partition of the mart at ``path`` (empty on a first run)."""
    return _storage_analysis(spark, t, asof, path)[0]


def run_storage_analysis(spark: SparkSession, t: Telemetry, asof: AsOf, path: str,
                         replace_partition: bool = False) -> dict[str, str]:
    """Returns the projects whose options were skipped, and why."""
    # Reads only yesterday's partition and writes today's: no file is both
    # read and replaced by this job.
    require_utc(spark)
    rows, skipped = _storage_analysis(spark, t, asof, path)
    sinks.append(rows, sinks.STORAGE_ANALYSIS, path, replace_partition)
    return skipped


# --- the daily schedule ------------------------------------------------------------
@dataclass
class DailyRun:
    """What one day's runs did: mart paths, errors by mart, skipped projects by mart."""

    paths: dict[str, str]
    errors: dict[str, Exception] = field(default_factory=dict)
    skipped: dict[str, dict[str, str]] = field(default_factory=dict)


class SkippedError(RuntimeError):
    """A pipeline was not run because the one that it reads failed."""


def run_daily(spark: SparkSession, t: Telemetry | Callable[[str], Telemetry], asof: AsOf, marts_root: str,
              **opts) -> DailyRun:
    """Run all seven pipelines for one as-of clock, marts below ``marts_root``.

    The pipelines are independent, as their schedules are: one that fails is
    reported and the others run.  The daily storage run precedes the monthly
    storage price, which reads its mart and is left out when it failed.
    ``t`` may be a function of the mart's name (see ``telemetry.export``);
    ``opts`` maps a mart's name to its keyword options.
    """
    run = DailyRun({name: f"{marts_root.rstrip('/')}/{name}" for name in sinks.MARTS})

    def attempt(name: str, pipeline: Callable) -> None:
        try:
            source = t(name) if callable(t) else t
            skipped = pipeline(source, run.paths[name], **opts.get(name, {}))
            if skipped:
                run.skipped[name] = skipped
        except Exception as exc:  # noqa: BLE001 - reported with the run
            run.errors[name] = exc

    attempt("daily_editions_compute_pricing", lambda s, path, **o: run_editions_day_pricing(s, asof, path, **o))
    attempt("daily_ondemand_compute_pricing", lambda s, path, **o: run_ondemand_day_pricing(s, asof, path, **o))
    attempt("daily_storage_usage", lambda s, path, **o: run_daily_storage_usage(s, asof, path, **o))
    attempt("query_analysis", lambda s, path, **o: run_query_analysis(s, asof, path, **o))
    attempt("slot_analysis", lambda s, path, **o: run_slot_analysis(s, asof, path, **o))
    attempt("storage_analysis", lambda s, path, **o: run_storage_analysis(spark, s, asof, path, **o))
    if "daily_storage_usage" in run.errors:
        run.errors["monthly_storage_pricing"] = SkippedError("daily_storage_usage failed")
    else:
        attempt("monthly_storage_pricing", lambda s, path, **o: run_monthly_storage_pricing(
            spark, s, asof, run.paths["daily_storage_usage"], path, **o))
    return run


def register_mart_views(spark: SparkSession, marts_root: str) -> list[str]:
    """Register each mart below ``marts_root`` as a temporary view of the same
    name (for ``spark.sql`` and BI tools); marts not created yet are skipped."""
    names = []
    for name, mart in sinks.MARTS.items():
        path = f"{marts_root.rstrip('/')}/{name}"
        if sinks.exists(spark, path):
            sinks.read(spark, mart, path).createOrReplaceTempView(name)
            names.append(name)
    return names

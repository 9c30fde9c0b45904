"""Edition (reservation) compute cost: slot use per minute, hour and day.

Plan shape, and why:

* The month filters are ranges on the raw UTC columns, so they reach the
  Parquet scan.
* The timeline is summed per (reservation, minute) *before* it meets the
  reservation minutes.  The scripts join every timeline row and subtract the
  baseline once per row; since that sum is linear, carrying ``sum(ms)`` and
  ``count(ms)`` per minute gives the same number while the join input shrinks
  from one row per job-second to one row per reservation-minute.  A hot
  reservation cannot skew this: the key includes the minute.
* The reservation timeline is cut to the minutes the filtered timeline can
  reach (the join is inner, so no result changes), and a project's timeline
  that the scripts insert once per reservation id is kept once with a copy
  count that multiplies the sums.
* Sums stay integers (ms, whole hundreds) and are divided once, so results do
  not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costbook.asof import AsOf
from costbook.constants import EXCLUDED_RESERVATION, HOURS_PER_DAY, SCRIPT_STATEMENT
from costbook.functions import (
    admin_project,
    ceil_hundreds,
    day_partition_bounds,
    in_range,
    local_date,
    month_labels,
    slot_hour_cents,
    trunc_hour,
    trunc_minute,
)
from costbook.operators.lookups import broadcast_if_small
from costbook.operators.prices import edition_price
from costbook.session import Staging
from costbook.sources.fanin import gather


# --- predicates ---------------------------------------------------------------
def filter_month_window(timeline: DataFrame, asof: AsOf, months_back: int = 0) -> DataFrame:
    """Jobs created, and periods started, in the current local month.

    ``months_back=1`` also admits jobs created in the previous month (their
    periods must still fall in the current month).
    """
    created_lo, created_hi = asof.month_window_utc(months_back)
    period_lo, period_hi = asof.month_window_utc(0)
    cols = timeline.columns
    return timeline.filter(
        in_range("job_creation_time", created_lo, created_hi)
        & in_range("period_start", period_lo, period_hi)
        & day_partition_bounds(cols, "period_start", period_lo, period_hi)
    )


def filter_reserved_jobs(timeline: DataFrame) -> DataFrame:
    """Reserved jobs only; scripts are left out, a NULL statement type is kept."""
    rid, st = F.col("reservation_id"), F.col("statement_type")
    return timeline.filter(
        rid.isNotNull() & (rid != F.lit(EXCLUDED_RESERVATION)) & ((st != F.lit(SCRIPT_STATEMENT)) | st.isNull())
    )


def edition_jobs(timeline: DataFrame, asof: AsOf, months_back: int = 0) -> DataFrame:
    """The script's ``job`` table: reservation, period start and slot ms."""
    return filter_reserved_jobs(filter_month_window(timeline, asof, months_back)).select(
        "reservation_id", "period_start", "period_slot_ms"
    )


# --- reservation minutes --------------------------------------------------------
def _checked_admin(reservation_id: Column) -> Column:
    admin = admin_project(reservation_id)
    message = F.concat(F.lit("reservation id without an administration project: "), reservation_id)
    return F.when(admin.isNull(), F.raise_error(message)).otherwise(admin)


def _admin_copies(reservation_ids: DataFrame, dedupe_projects: bool) -> DataFrame:
    """Administration projects in use, and how often the script takes each one's timeline."""
    ids = reservation_ids.select(_checked_admin(F.col("reservation_id")).alias("admin_project"))
    if dedupe_projects:
        return ids.distinct().withColumn("copies", F.lit(1).cast("bigint"))
    return ids.groupBy("admin_project").agg(F.count(F.lit(1)).alias("copies"))


def _with_edition(rt: DataFrame, reservations: DataFrame, match_reservation: bool) -> DataFrame:
    """Reservation minutes with the editions of their project's reservations (left)."""
    keys = ["project_id", "project_number"]
    lookup = reservations.select(*keys, "edition")
    if match_reservation:
        if "reservation_name" not in reservations.columns:
            raise ValueError("match_reservation needs a reservation_name column in the reservations")
        rt = rt.withColumn("_reservation_name", F.substring_index("reservation_id", ".", -1))
        lookup = reservations.select(*keys, F.col("reservation_name").alias("_reservation_name"), "edition")
        keys = keys + ["_reservation_name"]
    return rt.join(broadcast_if_small(lookup), on=keys, how="left")


def reservation_minutes(
    reservation_ids: DataFrame,
    reservation_timeline: DataFrame,
    reservations: DataFrame,
    minute_range=None,
    dedupe_projects: bool = False,
    weighted: bool = False,
    match_reservation: bool = False,
) -> DataFrame:
    """The script's ``res`` table: reservation, baseline, minute, edition.

    For every distinct reservation id the whole timeline of its
    administration project is taken, left-joined to that project's
    reservations on project id and number.  As in the script, ``k``
    reservation ids of one project bring its timeline ``k`` times, and ``n``
    reservations in a project repeat each minute ``n`` times, once per edition.
    ``dedupe_projects=True`` takes each project's timeline once.  An id that
    names no project fails the job.

    ``match_reservation=True`` also matches the reservation name (the part
    of the id after its last dot) against the reservations' ``reservation_name``,
    so each minute gets its own reservation's edition only.

    ``weighted=True`` returns each row once with a ``copies`` column (``k``)
    instead of ``k`` identical rows: a project with ``k`` reservations would
    otherwise hold ``k`` squared rows per minute.
    """
    admins = _admin_copies(reservation_ids, dedupe_projects)
    rt = reservation_timeline
    if minute_range is not None:
        rt = rt.filter(in_range("period_start", *minute_range)
                       & day_partition_bounds(rt.columns, "period_start", *minute_range))
    # Both lookups are per-project lists; broadcasting them (after a measurement)
    # keeps the timeline, whose rows share a handful of project keys, from
    # being shuffled by project.
    admins = broadcast_if_small(admins)
    with_edition = _with_edition(rt, reservations, match_reservation)
    res = with_edition.join(admins, with_edition["project_id"] == admins["admin_project"], "inner").select(
        "reservation_id",
        F.col("slots_assigned").alias("baseline"),
        "period_start",
        "edition",
        "copies",
    )
    if weighted:
        return res
    # the script's table: ``copies`` identical rows (a bounded generator, no join)
    return res.select(
        "reservation_id", "baseline", "period_start", "edition",
        F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
    ).drop("_copy")


# --- joins and roll-ups ------------------------------------------------------------
def join_timeline_reservation(job: DataFrame, res: DataFrame) -> DataFrame:
    """Row-level join of timeline rows to reservation minutes (inner)."""
    j = job.withColumn("period_minute", trunc_minute("period_start"))
    r = res.withColumnRenamed("period_start", "period_minute")
    return j.join(r, on=["period_minute", "reservation_id"], how="inner")


def minute_totals(job: DataFrame) -> DataFrame:
    """Per (reservation, minute): integer ``sum(ms)`` and ``count(ms)``."""
    return job.groupBy("reservation_id", trunc_minute("period_start").alias("period_minute")).agg(
        F.sum("period_slot_ms").alias("slot_ms"), F.count("period_slot_ms").alias("n_periods")
    )


def edition_slot_minute(totals: DataFrame, res: DataFrame) -> DataFrame:
    """Slot seconds per minute, rounded up to whole hundreds.

    ``CEIL(SUM(ms/1000 - baseline)/60/100)*100`` when the baseline is
    positive, else ``CEIL(SUM(ms/1000)/60/100)*100``; the baseline is
    subtracted once per timeline row, as the script does.  ``res`` may be
    weighted (a ``copies`` column): a row standing for ``k`` copies adds its
    totals ``k`` times.
    """
    r = res.withColumnRenamed("period_start", "period_minute")
    copies = F.col("copies") if "copies" in res.columns else F.lit(1)
    joined = totals.join(r, on=["reservation_id", "period_minute"], how="inner")
    return _slot_minute(joined, copies)


def _slot_minute(joined: DataFrame, copies: Column) -> DataFrame:
    g = joined.groupBy("reservation_id", "period_minute", "baseline", "edition").agg(
        F.sum(F.col("slot_ms") * copies).alias("slot_ms"), F.sum(F.col("n_periods") * copies).alias("n_periods")
    )
    b = F.col("baseline")
    net_ms = F.col("slot_ms") - F.lit(1000) * F.col("n_periods") * b
    per_minute = F.when(b > 0, ceil_hundreds(net_ms.cast("double") / 1000.0 / 60.0)).otherwise(
        ceil_hundreds(F.col("slot_ms").cast("double") / 1000.0 / 60.0)
    )
    return g.select("reservation_id", "period_minute", "baseline", "edition", per_minute.alias("slot_sec_minute"))


def edition_slot_hour(minutes: DataFrame) -> DataFrame:
    """Optimistic slot-hours per hour: ``CEIL(SUM(m)/3600*60*100)/100``.

    ``slot_hour_cents`` keeps the whole number of hundredths."""
    cents = slot_hour_cents(F.sum("slot_sec_minute"))
    return minutes.groupBy(
        "reservation_id", trunc_hour("period_minute").alias("period_hour"), "edition", "baseline"
    ).agg(cents.alias("slot_hour_cents"))


def edition_day_cost(hours: DataFrame, prices: DataFrame, asof: AsOf, latest_per_key: bool = False) -> DataFrame:
    """Cost per reservation and local day: the merge source of the editions mart.

    ``baseline_cost = baseline * 24 * price`` is a group key, as written.  The
    unit price depends on the edition only, so carrying it as a further key
    changes no group and prices each row once.
    """
    d = local_date("period_hour", asof.zone)
    labels = month_labels(d)
    priced = hours.withColumn("unit_price", edition_price(prices, F.col("edition"), asof.region, latest_per_key))
    keyed = priced.select(
        "reservation_id",
        d.alias("date"),
        labels["year"].alias("year"),
        labels["year_month"].alias("year_month"),
        "edition",
        ((F.col("baseline") * HOURS_PER_DAY).cast("double") * F.col("unit_price")).alias("baseline_cost"),
        "unit_price",
        "slot_hour_cents",
    )
    g = keyed.groupBy("reservation_id", "date", "year", "year_month", "edition", "baseline_cost", "unit_price").agg(
        F.sum("slot_hour_cents").alias("cents")
    )
    cost = (F.col("cents").cast("double") / 100.0) * F.col("unit_price")
    return g.select("reservation_id", "date", "year", "year_month", "edition", "baseline_cost", cost.alias("cost"))


def editions_source(
    timeline: DataFrame,
    reservation_timeline: DataFrame,
    reservations: DataFrame,
    prices: DataFrame,
    asof: AsOf,
    months_back: int = 0,
    dedupe_projects: bool = False,
    latest_per_key: bool = False,
    match_reservation: bool = False,
    staging: Staging | None = None,
) -> DataFrame:
    """The whole editions roll-up, ready for the upsert.

    The per-minute totals feed both the key list (which administration
    projects to read) and the minute join.  They are one row per
    reservation-minute, so they are staged as Parquet: the month's timeline is
    scanned once, and a lost executor does not send the job back to that scan.

    A source that exists once per administration project is gathered for the
    projects that the totals name; a missing or unreadable one stops the run.
    """
    staging = staging or Staging(timeline.sparkSession)
    totals = staging.table(minute_totals(edition_jobs(timeline, asof, months_back)), "minute-totals")
    ids = totals.select("reservation_id").distinct()
    admins = ids.select(_checked_admin(F.col("reservation_id")).alias("p"))
    reservation_timeline, _ = gather(reservation_timeline, admins, "p", "raise")
    reservations, _ = gather(reservations, admins, "p", "raise")
    res = reservation_minutes(
        ids, reservation_timeline, reservations, minute_range=asof.month_window_utc(0),
        dedupe_projects=dedupe_projects, weighted=True, match_reservation=match_reservation,
    )
    hours = edition_slot_hour(edition_slot_minute(totals, res))
    return edition_day_cost(hours, prices, asof, latest_per_key)


# --- from partial sums kept per UTC day -----------------------------------------------
def edition_minute_partials(timeline: DataFrame, reservation_timeline: DataFrame, reservations: DataFrame, asof: AsOf,
                            months_back: int = 0, match_reservation: bool = False) -> DataFrame:
    """Per UTC day folder: the minute totals that met reservation minutes, before the
    scripts' copies multiply them, and each reservation id seen (a row without a minute).

    How often a project's timeline counts depends on the month's reservation ids, so
    it is no part of a day.
    """
    part = "period_date"
    job = filter_reserved_jobs(filter_month_window(timeline, asof, months_back))
    totals = job.groupBy(F.col(part).alias("day"), "reservation_id", trunc_minute("period_start").alias("period_minute")).agg(
        F.sum("period_slot_ms").alias("slot_ms"), F.count("period_slot_ms").alias("n_periods"))
    lo, hi = asof.month_window_utc(0)
    rt = _with_edition(reservation_timeline.filter(in_range("period_start", lo, hi)), reservations, match_reservation).select(
        "project_id", "reservation_id", F.col("slots_assigned").alias("baseline"), F.col("period_start").alias("period_minute"), "edition")
    met = totals.join(rt, on=["reservation_id", "period_minute"], how="inner").groupBy(
        "day", "project_id", "reservation_id", "period_minute", "baseline", "edition").agg(
        F.sum("slot_ms").alias("slot_ms"), F.sum("n_periods").alias("n_periods"))
    seen = totals.select("day", "reservation_id").distinct()
    return met.unionByName(seen, allowMissingColumns=True)


def edition_cost_of_partials(partials: DataFrame, prices: DataFrame, asof: AsOf, dedupe_projects: bool = False,
                             latest_per_key: bool = False) -> DataFrame:
    """The rows of :func:`editions_source`, from partial sums."""
    ids = partials.filter("period_minute IS NULL").select("reservation_id").distinct()
    admins = broadcast_if_small(_admin_copies(ids, dedupe_projects))
    met = partials.filter("period_minute IS NOT NULL")
    joined = met.join(admins, met["project_id"] == admins["admin_project"], "inner")
    return edition_day_cost(edition_slot_hour(_slot_minute(joined, F.col("copies"))), prices, asof, latest_per_key)

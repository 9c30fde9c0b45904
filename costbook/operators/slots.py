"""Slot use per job: per second, per minute (mean and peak), per job.

The timeline is hash-partitioned once on the job keys ``(project, job, user)``.
The per-second, per-minute and per-job roll-ups group by supersets of these
columns, so they run in place with no further shuffle.  A job has at most one
row per second, about 110,000 in the window: no job key is hot.  The two left
joins with the jobs run in place too (job text on the job keys, slot-hours on the job
keys plus reservation).  The slot side carries, per job, a map from
reservation to its slot-hours; looking up the job's own reservation is the
four-key equality join (a NULL reservation finds nothing), with one
partitioning shared by all three inputs.

All sums are integer milliseconds or whole hundreds, divided once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costbook.asof import AsOf
from costbook.constants import FINISHED_STATE
from costbook.functions import ceil_hundreds, date_lit, slot_hours, trunc_minute
from costbook.operators.jobs import JOB_KEYS, filter_recent_window, filter_states, job_seconds, job_statements, text_of_days

SLOT_KEYS = ["project_id", "job_id", "user_email", "reservation_id"]


def recent_timeline(timeline: DataFrame, asof: AsOf, window: str = "as_written",
                    states=(FINISHED_STATE,)) -> DataFrame:
    return filter_states(filter_recent_window(timeline, "period_start", asof, window), states)


def slot_second(timeline: DataFrame) -> DataFrame:
    """``SUM(period_slot_ms)`` per second and job (``slot_sec = ms / 1000``)."""
    placed = timeline.withColumn("period_minute", trunc_minute("period_start")).repartition(*JOB_KEYS)
    return placed.groupBy("period_start", "period_minute", *SLOT_KEYS).agg(
        F.sum("period_slot_ms").alias("slot_ms")
    )


def slot_minute(seconds: DataFrame) -> DataFrame:
    """Per minute: ``CEIL(SUM(slot_sec)/60/100)*100`` and ``CEIL(MAX(slot_sec)/100)*100``."""
    g = seconds.groupBy("period_minute", *SLOT_KEYS).agg(
        F.sum("slot_ms").alias("sum_ms"), F.max("slot_ms").alias("max_ms")
    )
    avg = ceil_hundreds(F.col("sum_ms").cast("double") / 1000.0 / 60.0)
    peak = ceil_hundreds(F.col("max_ms").cast("double") / 1000.0)
    return g.select("period_minute", *SLOT_KEYS, avg.alias("slot_sec_average_in_minute"),
                    peak.alias("slot_sec_max_in_minute"))


def slot_job_hours(minutes: DataFrame) -> DataFrame:
    """Optimistic and pessimistic slot-hours per job: ``CEIL(SUM(m)/3600*60*100)/100``."""
    return minutes.groupBy(*SLOT_KEYS).agg(
        slot_hours(F.sum("slot_sec_average_in_minute")).alias("optimistic_slot_hour"),
        slot_hours(F.sum("slot_sec_max_in_minute")).alias("pessmistic_slot_hour"),
    )


def slot_hours_by_job(minutes: DataFrame) -> DataFrame:
    """Per job keys: ``slot_by_reservation``, a map reservation -> slot-hours.

    The per-job roll-up groups by the job keys and the reservation; rows are
    unique per reservation, and a NULL reservation (which no equality join can
    match) is left out of the map.
    """
    hours = slot_job_hours(minutes).filter(F.col("reservation_id").isNotNull())
    entry = F.struct("reservation_id", F.struct("optimistic_slot_hour", "pessmistic_slot_hour"))
    return hours.groupBy(*JOB_KEYS).agg(F.map_from_entries(F.collect_list(entry)).alias("slot_by_reservation"))


def slot_analysis_rows(jobs: DataFrame, timeline: DataFrame, job_text: DataFrame, asof: AsOf,
                       window: str = "as_written", states=(FINISHED_STATE,),
                       timeline_states=(FINISHED_STATE,)) -> DataFrame:
    """Rows appended to the slot-analysis mart."""
    recent = job_seconds(filter_states(filter_recent_window(jobs, "start_time", asof, window), states)).select(
        "project_id", "reservation_id", "job_id", "user_email", "cache_hit", "creation_time", "start_time", "end_time",
        "query_execution_seconds", "statement_type",
    )
    slots = slot_hours_by_job(slot_minute(slot_second(recent_timeline(timeline, asof, window, timeline_states))))
    statements = job_statements(text_of_days(job_text, recent))
    joined = recent.join(statements, on=JOB_KEYS, how="left").join(slots, on=JOB_KEYS, how="left")
    own = F.col("slot_by_reservation")[F.col("reservation_id")]
    joined = joined.withColumns({"optimistic_slot_hour": own["optimistic_slot_hour"],
                                 "pessmistic_slot_hour": own["pessmistic_slot_hour"]})
    return joined.select(
        "project_id",
        "job_id",
        F.col("user_email").alias("account"),
        "reservation_id",
        F.col("cache_hit").alias("cache"),
        F.col("optimistic_slot_hour").alias("slot_min"),
        F.col("pessmistic_slot_hour").alias("slot_max"),
        F.col("start_time").alias("job_start"),
        F.col("end_time").alias("job_end"),
        F.col("query_execution_seconds").alias("job_time"),
        F.col("statement_type").alias("query_type"),
        F.col("statement").alias("query"),
        date_lit(asof.today).alias("date"),
        F.lit(asof.year_month_label).alias("year_month"),
        F.lit(asof.year_label).alias("year"),
    )

"""Per-job analysis: recent finished jobs, run time, billed size, job text.

The recent-job set and the job text are joined on (project, job, user).  The
jobs are hash-partitioned on exactly these three join keys once; the
billed-size roll-up (grouped by eight columns that include them) and the
sort-merge join with the text both accept that partitioning, so the jobs side
is shuffled a single time (a roll-up of one row per job gains nothing from a
map-side partial sum).
The scripts put no time filter on the job text.  Spark's runtime Bloom filter,
built from the selected jobs, trims it before its shuffle, and of an export
laid out by the job's creation day only the days of the selected jobs are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costbook.asof import AsOf
from costbook.constants import FINISHED_STATE
from costbook.functions import TIB, between_closed, date_lit, day_partition_bounds, ms_between
from costbook.functions.timecols import DAY_PARTITION_OF
from costbook.session import Staging

JOB_KEYS = ["project_id", "job_id", "user_email"]


def filter_recent_window(df: DataFrame, column: str, asof: AsOf, window: str = "as_written") -> DataFrame:
    """``column BETWEEN yesterday 00:00 AND now - 5 min`` (see AsOf.recent_window)."""
    lo, hi = asof.recent_window(window)
    return df.filter(between_closed(column, lo, hi) & day_partition_bounds(df.columns, column, lo, hi))


def filter_states(df: DataFrame, states=(FINISHED_STATE,)) -> DataFrame:
    """``state = 'DONE'`` by default; ``states=None`` keeps every state."""
    if states is None:
        return df
    return df.filter(F.col("state").isin(list(states)))


def job_seconds(jobs: DataFrame) -> DataFrame:
    """Run time in seconds: ``TIMESTAMP_DIFF(end, start, MILLISECOND) / 1000``."""
    return jobs.withColumn("query_execution_seconds", ms_between("start_time", "end_time").cast("double") / 1000.0)


def recent_jobs(jobs: DataFrame, asof: AsOf, window: str = "as_written", states=(FINISHED_STATE,)) -> DataFrame:
    return filter_states(filter_recent_window(jobs, "start_time", asof, window), states)


def job_billed(recent: DataFrame) -> DataFrame:
    """The query-analysis ``jobs`` table: billed TiB per job (eight group keys)."""
    keyed = job_seconds(recent).repartition(*JOB_KEYS)
    return keyed.groupBy(
        "project_id", "job_id", "user_email", "cache_hit", "start_time", "end_time",
        "query_execution_seconds", "statement_type",
    ).agg((F.sum("total_bytes_billed").cast("double") / F.lit(TIB)).alias("total_terabytes_billed"))


def job_statements(job_text: DataFrame) -> DataFrame:
    return job_text.select(*JOB_KEYS, F.col("query").alias("statement"))


def text_of_days(job_text: DataFrame, recent: DataFrame) -> DataFrame:
    """The job text of the UTC days on which the selected jobs were created.

    Only for an export laid out by ``creation_date`` (the job's creation day);
    any other is returned as it is.  The days are few (one row each), so their
    broadcast is bounded, and dynamic partition pruning takes them to the scan:
    the folders of other days are not read.
    """
    part = DAY_PARTITION_OF["creation_time"]
    if part not in job_text.columns:
        return job_text
    days = recent.select(F.to_date("creation_time").alias(part)).distinct()
    return job_text.join(F.broadcast(days), on=part, how="left_semi")


def selected_statements(job_text: DataFrame, recent: DataFrame) -> DataFrame:
    """The statements of the selected jobs.

    Keeping only text rows of the selected jobs changes nothing in a left join,
    but gives Spark a plain filtered scan to build its runtime Bloom filter from
    (it cannot see through the roll-up, nor does it take a scan without a
    selective predicate), so the job text is filtered before it is shuffled; the
    semi-join's partitioning is then reused by the left join.
    """
    return job_statements(text_of_days(job_text, recent)).join(recent.select(*JOB_KEYS), on=JOB_KEYS, how="left_semi")


def query_analysis_rows(jobs: DataFrame, job_text: DataFrame, asof: AsOf, window: str = "as_written",
                        states=(FINISHED_STATE,), staging: Staging | None = None) -> DataFrame:
    """Rows appended to the query-analysis mart.

    The window's finished jobs are staged once and feed the roll-up, the
    semi-join and the Bloom filters that Spark builds from them, so the jobs
    export is scanned once.  The window is named again on the staged rows: it
    drops none, and is the selective predicate without which Spark builds no
    runtime filter.
    """
    staging = staging or Staging(jobs.sparkSession)
    columns = [*JOB_KEYS, "cache_hit", "creation_time", "start_time", "end_time", "statement_type", "total_bytes_billed"]
    staged = staging.table(recent_jobs(jobs, asof, window, states).select(*columns), "recent-jobs")
    recent = staged.filter(between_closed("start_time", *asof.recent_window(window)))
    billed = job_billed(recent)
    statements = selected_statements(job_text, recent)
    joined = billed.join(statements, on=JOB_KEYS, how="left")
    return joined.select(
        "project_id",
        "job_id",
        F.col("user_email").alias("account"),
        F.col("statement").alias("query"),
        F.col("total_terabytes_billed").alias("query_size"),
        F.col("cache_hit").alias("cache"),
        F.col("start_time").alias("query_start"),
        F.col("end_time").alias("query_end"),
        F.col("query_execution_seconds").alias("query_time"),
        F.col("statement_type").alias("query_type"),
        date_lit(asof.today).alias("date"),
        F.lit(asof.year_month_label).alias("year_month"),
        F.lit(asof.year_label).alias("year"),
    )

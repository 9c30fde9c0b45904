"""Telemetry inputs of the pipelines.

The scheduled scripts query live warehouse views.  Here every view is an
exported table: one dataset per view, read with its declared columns.  Views
that the scripts read "one per project" (job text, reservation timeline,
reservations, schema options) are single datasets holding the project column,
or a :class:`costbook.sources.fanin.PerProject`, one folder per project.

An export laid out by the UTC day of a timestamp is read through the folders
of the days that a pipeline's window touches: :func:`export` knows the windows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from costbook import schemas
from costbook.asof import AsOf
from costbook.functions.timecols import DAY_PARTITION_OF
from costbook.session import require_utc
from costbook.sources.fanin import PerProject

# Dataset names below an export root, and their schemas.
TABLES = {
    "jobs": schemas.JOBS,
    "jobs_timeline": schemas.JOBS_TIMELINE,
    "job_text": schemas.JOB_TEXT,
    "reservation_timeline": schemas.RESERVATION_TIMELINE,
    "reservations": schemas.RESERVATIONS,
    "table_storage": schemas.TABLE_STORAGE,
    "schema_options": schemas.SCHEMA_OPTIONS,
    "price_compute": schemas.PRICE_COMPUTE,
    "price_storage": schemas.PRICE_STORAGE,
}


@dataclass(frozen=True)
class Telemetry:
    """The inputs of all seven pipelines, as lazy DataFrames or per-project sources."""

    jobs: DataFrame
    jobs_timeline: DataFrame
    job_text: DataFrame | PerProject
    reservation_timeline: DataFrame | PerProject
    reservations: DataFrame | PerProject
    table_storage: DataFrame
    schema_options: DataFrame | PerProject
    price_compute: DataFrame
    price_storage: DataFrame

    def with_(self, **frames) -> "Telemetry":
        return replace(self, **frames)

    @property
    def spark(self) -> SparkSession:
        return self.jobs.sparkSession


# Columns kept when an export has them (used by opt-in corrections only).
OPTIONAL = {"reservations": schemas.RESERVATIONS_OPTIONAL.fields}

# Day partition columns an export may be laid out by (UTC day of a timestamp).
# When present they are kept, and the window filters add the partition predicate.
DAY_PARTITION_COLUMNS = tuple(DAY_PARTITION_OF.values())


def read_table(spark: SparkSession, root: str, name: str, column: str | None = None,
               window: tuple[datetime, datetime] | None = None) -> DataFrame:
    """Read one exported dataset, cast to its declared columns.

    Spark infers the schema from a footer, so that exports with other integer
    widths or zoned timestamps are accepted; columns outside the schema are not
    read.  With ``column`` and ``window``, an export laid out by that column's
    day is listed and read for the days of the window only.
    """
    path = f"{root}/{name}"
    if window is None:
        return _typed(spark, name, path, [path])
    by_day = day_folders(spark, root, name, column, *window)
    paths = [path] if by_day is None else list(by_day.values())
    return _typed(spark, name, path, paths) if paths else spark.createDataFrame([], TABLES[name])


def read_days(spark: SparkSession, root: str, name: str, folders: list[str]) -> DataFrame:
    """The rows of these day folders of a dataset, the day column kept."""
    return _typed(spark, name, f"{root}/{name}", folders)


def _typed(spark: SparkSession, name: str, base: str, paths: list[str]) -> DataFrame:
    df = spark.read.option("basePath", base).parquet(*paths)
    parts = [F.col(c).cast("date").alias(c) for c in DAY_PARTITION_COLUMNS if c in df.columns]
    optional = [_cast(df, f) for f in OPTIONAL.get(name, ()) if f.name in df.columns]
    return df.select(*[_cast(df, f) for f in TABLES[name].fields], *optional, *parts)


def _cast(df: DataFrame, field) -> Column:
    """The column in its declared type; a zoned timestamp becomes its UTC wall clock,
    whatever zone the session has (a cast would take the session's)."""
    c = df[field.name]
    if isinstance(df.schema[field.name].dataType, TimestampType) and isinstance(field.dataType, TimestampNTZType):
        since = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.unix_micros(c).cast("decimal(20,0)") / 1000000).cast("decimal(18,6)"))
        c = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since
    return c.cast(field.dataType).alias(field.name)


def day_folders(spark: SparkSession, root: str, name: str, column: str, lo: datetime, hi: datetime) -> dict[date, str] | None:
    """The existing day folders from ``lo`` to ``hi`` of a dataset laid out by ``column``'s
    day; None for one that is not."""
    path, part = f"{root}/{name}", DAY_PARTITION_OF[column]
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = jpath(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not len(fs.globStatus(jpath(f"{path}/{part}=*")) or ()):
        return None
    days = [lo.date() + timedelta(days=k) for k in range((hi.date() - lo.date()).days + 1)]
    folders = {d: f"{path}/{part}={d.isoformat()}" for d in days}
    return {d: f for d, f in folders.items() if fs.exists(jpath(f))}


def read_telemetry(spark: SparkSession, root: str, windows: dict[str, tuple] | None = None) -> Telemetry:
    """All datasets below ``root``; ``windows`` maps a dataset to (column, window)."""
    require_utc(spark)
    windows = windows or {}
    return Telemetry(**{name: read_table(spark, root, name, *windows.get(name, ())) for name in TABLES})


def export(spark: SparkSession, root: str, asof: AsOf, window: str = "as_written") -> Callable[[str], Telemetry]:
    """The telemetry at ``root`` by mart: each pipeline lists the days of its own windows."""
    month, recent = asof.month_window_utc(0), asof.recent_window(window)
    windows = {
        "daily_editions_compute_pricing": {"jobs_timeline": ("period_start", month),
                                           "reservation_timeline": ("period_start", month)},
        "daily_ondemand_compute_pricing": {"jobs": ("creation_time", asof.month_window_utc(1))},
        "query_analysis": {"jobs": ("start_time", recent)},
        "slot_analysis": {"jobs": ("start_time", recent), "jobs_timeline": ("period_start", recent)},
    }
    return lambda mart: read_telemetry(spark, root, windows.get(mart))

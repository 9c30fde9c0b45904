"""Telemetry derived from the driver's test tables.

The driver ships TPC-H-like tables plus an ``events`` stream, not warehouse
telemetry.  This module maps them onto the telemetry schemas with plain
column expressions (no Python UDF, no collect), so every registered query
scans the given tables and its work grows with them.  The oracle SQL in
:mod:`costbook.plans.oracle` applies the same mapping in DuckDB.

Mapping (events ``e``, lineitem ``l``):

* job: project ``proj-{user_id % 7}``, id ``job-{event_id}``, user
  ``user{user_id}@example.com``; reservation by ``user_id``: ``% 10 = 9``
  the unparsable ``default-pipeline``, else by ``% 4``: NULL (on demand),
  ``admin-a:...std``, ``admin-b:...ent``, ``admin-b:...entplus``; created and
  started at ``ts``, ended ``round(value*1000)`` ms later;
  ``round(value*1e9)`` bytes billed; cache hit for views; statement by event
  type; RUNNING when ``event_id % 10 = 0``, else DONE.
* times: ``ts`` is moved for a share of the events, see ``spread``; jobs of
  ``event_id % 10 = 2`` were created a month before they start.
* timeline (its own state: RUNNING when ``(event_id + i) % 10 = 0``): three periods per job, 30 s apart from ``ts`` cut to the second,
  ``round(value*100) * 1000 * (i+1)`` slot ms (whole slot seconds).
* job text: ``event_type || ' ' || props``, missing when ``event_id % 13 = 0``.
* reservation timeline: each reservation-minute of the timeline; baseline
  0 (std), 50 before 12:00 UTC and 100 after (ent), 100 (entplus).
* reservations: one row per (admin project, edition) in use.
* table storage: one table per lineitem row, project ``l_orderkey % 7``,
  dataset ``l_partkey % 23``, byte counts scaled from the numeric columns.
* schema options: per dataset by ``dataset % 3``: PHYSICAL, none, LOGICAL;
  none at all for ``proj-6`` (an unreadable project).
* daily storage history: per project and UTC day, ``sum(round(value*100))``
  times 1, 2, 3, 4 for the four sizes (whole numbers, so means are exact).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costbook import schemas
from costbook.functions import admin_project, ntz, trunc_minute
from costbook.sources.telemetry import Telemetry

# Reservation ids of the fixture and the edition each stands for.
RESERVATION_STD = "admin-a:asia-northeast1.std"
RESERVATION_ENT = "admin-b:asia-northeast1.ent"
RESERVATION_ENTPLUS = "admin-b:asia-northeast1.entplus"
RESERVATION_UNPARSABLE = "default-pipeline"
EDITION_OF_RESERVATION = {
    RESERVATION_STD: "STANDARD",
    RESERVATION_ENT: "ENTERPRISE",
    RESERVATION_ENTPLUS: "ENTERPRISE_PLUS",
}
PROJECT_NUMBER = {"admin-a": 1001, "admin-b": 1002}

# Invented price lists (the scripts ship placeholders only).
# Two revisions, two regions.  Compute: (class, price, region, start date).
PRICE_COMPUTE_ROWS = [
    ("on_demand", 6.0, "asia-northeast1", date(2023, 7, 1)),
    ("standard", 0.051, "asia-northeast1", date(2023, 7, 1)),
    ("enterprise", 0.0765, "asia-northeast1", date(2023, 7, 1)),
    ("enterprise_plus", 0.1275, "asia-northeast1", date(2023, 7, 1)),
    ("on_demand", 5.0, "us", date(2023, 7, 1)),
    ("standard", 0.04, "us", date(2023, 7, 1)),
    ("enterprise", 0.06, "us", date(2023, 7, 1)),
    ("enterprise_plus", 0.1, "us", date(2023, 7, 1)),
    ("on_demand", 7.5, "asia-northeast1", date(2024, 1, 1)),
    ("standard", 0.051, "asia-northeast1", date(2024, 1, 1)),
    ("enterprise", 0.0918, "asia-northeast1", date(2024, 1, 1)),
    ("enterprise_plus", 0.153, "asia-northeast1", date(2024, 1, 1)),
    ("on_demand", 6.25, "us", date(2024, 1, 1)),
    ("standard", 0.04, "us", date(2024, 1, 1)),
    ("enterprise", 0.06, "us", date(2024, 1, 1)),
    ("enterprise_plus", 0.1, "us", date(2024, 1, 1)),
]
# Storage: (active logical, long-term logical, active physical,
# long-term physical, region, start date).
PRICE_STORAGE_ROWS = [
    (0.023, 0.016, 0.052, 0.026, "asia-northeast1", date(2023, 7, 1)),
    (0.02, 0.01, 0.04, 0.02, "us", date(2023, 7, 1)),
    (0.025, 0.0125, 0.05, 0.025, "asia-northeast1", date(2024, 1, 1)),
    (0.02, 0.01, 0.04, 0.02, "us", date(2024, 1, 1)),
]
# A later revision that covers one class, or the other region, only: as written
# it makes all other prices NULL; the newest price per key stays.
PARTIAL_COMPUTE_ROWS = [("enterprise", 0.1, "asia-northeast1", date(2024, 1, 20))]
PARTIAL_STORAGE_ROWS = [(0.021, 0.011, 0.041, 0.021, "us", date(2024, 1, 20))]
PRICE_REVISION_DATES = (date(2023, 7, 1), date(2024, 1, 1))


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _project(user_id: Column) -> Column:
    return F.concat(F.lit("proj-"), (user_id % 7).cast("string"))


def _reservation(user_id: Column) -> Column:
    return (
        F.when(user_id % 10 == 9, F.lit(RESERVATION_UNPARSABLE))
        .when(user_id % 4 == 1, F.lit(RESERVATION_STD))
        .when(user_id % 4 == 2, F.lit(RESERVATION_ENT))
        .when(user_id % 4 == 3, F.lit(RESERVATION_ENTPLUS))
    )


def _statement(event_type: Column) -> Column:
    return (
        F.when(event_type == "click", F.lit("SELECT"))
        .when(event_type == "view", F.lit("INSERT"))
        .when(event_type == "purchase", F.lit("MERGE"))
        .when(event_type == "signup", F.lit("SCRIPT"))
    )


def _job_columns() -> dict[str, Column]:
    uid = F.col("user_id")
    return {
        "project_id": _project(uid),
        "job_id": F.concat(F.lit("job-"), F.col("event_id").cast("string")),
        "user_email": F.concat(F.lit("user"), uid.cast("string"), F.lit("@example.com")),
        "reservation_id": _reservation(uid),
        "statement_type": _statement(F.col("event_type")),
        "state": F.when(F.col("event_id") % 10 == 0, F.lit("RUNNING")).otherwise(F.lit("DONE")),
    }


def spread(events: DataFrame) -> DataFrame:
    """The events with ``ts`` moved for a share of them (by ``event_id % 10``: 3 a month
    back, 7 two months back, 5 a month on) and ``created``, a month before ``ts`` for 2:
    so that every window has rows outside it."""
    n = F.col("event_id") % 10
    days = F.when(n == 3, -31).when(n == 7, -62).when(n == 5, 31).otherwise(0)
    moved = events.withColumn("ts", F.timestamp_add("DAY", days, F.col("ts").cast("timestamp_ntz")))
    return moved.withColumn("created", F.timestamp_add("DAY", F.when(n == 2, -31).otherwise(0), F.col("ts")))


def jobs(events: DataFrame) -> DataFrame:
    c = _job_columns()
    ts = F.col("ts")
    return spread(events).select(
        c["project_id"].alias("project_id"),
        c["job_id"].alias("job_id"),
        c["user_email"].alias("user_email"),
        c["reservation_id"].alias("reservation_id"),
        F.col("created").alias("creation_time"),
        ts.alias("start_time"),
        F.timestamp_add("MILLISECOND", F.round(F.col("value") * 1000).cast("bigint"), ts).alias("end_time"),
        F.round(F.col("value") * 1e9).cast("bigint").alias("total_bytes_billed"),
        (F.col("event_type") == "view").alias("cache_hit"),
        c["statement_type"].alias("statement_type"),
        c["state"].alias("state"),
    )


def jobs_timeline(events: DataFrame) -> DataFrame:
    c = _job_columns()
    ts = F.col("ts")
    i = F.col("period_index")
    running = (F.col("event_id") + i) % 10 == 0
    return (
        spread(events).select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("period_index"))
        .select(
            c["project_id"].alias("project_id"),
            c["job_id"].alias("job_id"),
            c["user_email"].alias("user_email"),
            c["reservation_id"].alias("reservation_id"),
            F.col("created").alias("job_creation_time"),
            F.timestamp_add("SECOND", i * 30, F.date_trunc("second", ts).cast("timestamp_ntz")).alias("period_start"),
            (F.round(F.col("value") * 100).cast("bigint") * 1000 * (i + 1)).alias("period_slot_ms"),
            c["statement_type"].alias("statement_type"),
            F.when(running, F.lit("RUNNING")).otherwise(F.lit("DONE")).alias("state"),
        )
    )


def job_text(events: DataFrame) -> DataFrame:
    c = _job_columns()
    return events.filter(F.col("event_id") % 13 != 0).select(
        c["project_id"].alias("project_id"),
        c["job_id"].alias("job_id"),
        c["user_email"].alias("user_email"),
        F.concat(F.col("event_type"), F.lit(" "), F.col("props")).alias("query"),
    )


def _project_number(admin: Column) -> Column:
    expr = F.lit(None).cast("bigint")
    for name, number in PROJECT_NUMBER.items():
        expr = F.when(admin == name, F.lit(number)).otherwise(expr)
    return expr


def _edition_of(reservation_id: Column) -> Column:
    expr = F.lit(None).cast("string")
    for rid, edition in EDITION_OF_RESERVATION.items():
        expr = F.when(reservation_id == rid, F.lit(edition)).otherwise(expr)
    return expr


def _parsable_reservation(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reservation_id").isNotNull() & (F.col("reservation_id") != RESERVATION_UNPARSABLE))


def reservation_timeline(timeline: DataFrame) -> DataFrame:
    minutes = (
        _parsable_reservation(timeline)
        .select("reservation_id", trunc_minute("period_start").alias("period_start"))
        .distinct()
    )
    rid = F.col("reservation_id")
    baseline = (
        F.when(rid == RESERVATION_STD, F.lit(0))
        .when(rid == RESERVATION_ENT, F.when(F.hour("period_start") < 12, F.lit(50)).otherwise(F.lit(100)))
        .when(rid == RESERVATION_ENTPLUS, F.lit(100))
    )
    admin = admin_project(rid)
    return minutes.select(
        admin.alias("project_id"),
        _project_number(admin).alias("project_number"),
        rid.alias("reservation_id"),
        baseline.cast("bigint").alias("slots_assigned"),
        F.col("period_start"),
    )


def reservations(jobs_or_timeline: DataFrame) -> DataFrame:
    """One row per (administration project, edition) in use."""
    rids = _parsable_reservation(jobs_or_timeline).select("reservation_id").distinct()
    admin = admin_project("reservation_id")
    return rids.select(
        admin.alias("project_id"),
        _project_number(admin).alias("project_number"),
        _edition_of(F.col("reservation_id")).alias("edition"),
        F.substring_index("reservation_id", ".", -1).alias("reservation_name"),
    ).distinct()


def table_storage(lineitem: DataFrame) -> DataFrame:
    def scaled(col: str, factor: float) -> Column:
        return F.round(F.col(col) * factor).cast("bigint")

    return lineitem.select(
        F.concat(F.lit("proj-"), (F.col("l_orderkey") % 7).cast("string")).alias("project_id"),
        F.concat(F.lit("dataset_"), (F.col("l_partkey") % 23).cast("string")).alias("table_schema"),
        F.concat(
            F.lit("table_"), F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string")
        ).alias("table_name"),
        scaled("l_extendedprice", 1e5).alias("active_logical_bytes"),
        scaled("l_quantity", 1e7).alias("long_term_logical_bytes"),
        scaled("l_extendedprice", 4e4).alias("active_physical_bytes"),
        scaled("l_quantity", 3e6).alias("long_term_physical_bytes"),
        scaled("l_discount", 1e7).alias("time_travel_physical_bytes"),
        scaled("l_tax", 1e7).alias("fail_safe_physical_bytes"),
    )


def schema_options(lineitem: DataFrame) -> DataFrame:
    """Billing-model options per dataset, plus an unrelated option row."""
    datasets = lineitem.select(
        (F.col("l_orderkey") % 7).alias("p"), (F.col("l_partkey") % 23).alias("d")
    ).distinct()
    datasets = datasets.filter(F.col("p") != 6)
    catalog = F.concat(F.lit("proj-"), F.col("p").cast("string"))
    schema = F.concat(F.lit("dataset_"), F.col("d").cast("string"))
    model = F.when(F.col("d") % 3 == 0, F.lit("PHYSICAL")).when(F.col("d") % 3 == 2, F.lit("LOGICAL"))
    billing = datasets.filter(F.col("d") % 3 != 1).select(
        catalog.alias("catalog_name"),
        schema.alias("schema_name"),
        F.lit("storage_billing_model").alias("option_name"),
        model.alias("option_value"),
    )
    other = datasets.filter(F.col("d") % 3 == 1).select(
        catalog.alias("catalog_name"),
        schema.alias("schema_name"),
        F.lit("default_table_expiration_days").alias("option_name"),
        F.lit("30").alias("option_value"),
    )
    return billing.unionByName(other)


def price_compute(spark: SparkSession, up_to: date | None = None) -> DataFrame:
    rows = [r for r in PRICE_COMPUTE_ROWS if up_to is None or r[3] <= up_to]
    return spark.createDataFrame(rows, schemas.PRICE_COMPUTE)


def price_storage(spark: SparkSession, up_to: date | None = None) -> DataFrame:
    rows = [r for r in PRICE_STORAGE_ROWS if up_to is None or r[5] <= up_to]
    return spark.createDataFrame(rows, schemas.PRICE_STORAGE)


def with_partial_revision(t: Telemetry) -> Telemetry:
    """The telemetry with a revision that covers only some of the prices."""
    spark = t.spark
    return t.with_(
        price_compute=t.price_compute.unionByName(spark.createDataFrame(PARTIAL_COMPUTE_ROWS, schemas.PRICE_COMPUTE)),
        price_storage=t.price_storage.unionByName(spark.createDataFrame(PARTIAL_STORAGE_ROWS, schemas.PRICE_STORAGE)))


def daily_storage_history(events: DataFrame) -> DataFrame:
    """Rows of the daily storage mart for the days covered by ``events``."""
    hundredths = F.sum(F.round(F.col("value") * 100).cast("bigint"))
    per_day = spread(events).groupBy(
        _project(F.col("user_id")).alias("project_id"), F.to_date(F.col("ts")).alias("date")
    ).agg(hundredths.alias("s"))
    s = F.col("s").cast("double")
    return per_day.select(
        "project_id",
        (s * 1).alias("logic_active"),
        (s * 2).alias("logic_long_term"),
        (s * 3).alias("comp_active"),
        (s * 4).alias("comp_long_term"),
        "date",
    )


def telemetry(spark: SparkSession, sf_dir: str, price_up_to: date | None = None) -> Telemetry:
    """All pipeline inputs derived from the driver tables at ``sf_dir``.

    The fixture's session runs in UTC: the driver's tables hold UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = read_driver_table(spark, sf_dir, "events")
    lineitem = read_driver_table(spark, sf_dir, "lineitem")
    timeline = jobs_timeline(events)
    job_rows = jobs(events)
    return Telemetry(
        jobs=job_rows,
        jobs_timeline=timeline,
        job_text=job_text(events),
        reservation_timeline=reservation_timeline(timeline),
        reservations=reservations(job_rows),  # same reservation ids as the timeline, a third of the rows
        table_storage=table_storage(lineitem),
        schema_options=schema_options(lineitem),
        price_compute=price_compute(spark, price_up_to),
        price_storage=price_storage(spark, price_up_to),
    )


def known_at(t: Telemetry, instant) -> Telemetry:
    """The job telemetry as it stood at ``instant`` (for replaying an earlier
    scheduled run): jobs created, and timeline periods started, by then."""
    return t.with_(
        jobs=t.jobs.filter(F.col("creation_time") <= ntz(instant)),
        jobs_timeline=t.jobs_timeline.filter(F.col("period_start") <= ntz(instant)),
    )

"""Plan properties: pushed filters, no Python in the plan, shuffle counts."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from costbook.asof import DEFAULT_ASOF as A
from costbook.operators import editions, jobs, ondemand, slots
from costbook.plans.registry import QUERIES
from costbook.sources import fixtures
from costbook.sources.telemetry import TABLES, read_telemetry


def _plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().simpleString()


@pytest.fixture(scope="module")
def exported(spark, tmp_path_factory):
    """The fixture telemetry written as an export, read back with the readers."""
    root = str(tmp_path_factory.mktemp("export"))
    t = fixtures.telemetry(spark, SF_SMALL)
    for name in TABLES:
        getattr(t, name).write.parquet(f"{root}/{name}")
    return read_telemetry(spark, root)


@pytest.mark.parametrize("build,column", [
    (lambda t: editions.filter_month_window(t.jobs_timeline, A), "job_creation_time"),
    (lambda t: editions.filter_month_window(t.jobs_timeline, A), "period_start"),
    (lambda t: ondemand.filter_two_month_window(t.jobs, A), "creation_time"),
    (lambda t: jobs.filter_recent_window(t.jobs, "start_time", A), "start_time"),
    (lambda t: slots.recent_timeline(t.jobs_timeline, A), "period_start"),
])
def test_window_filters_reach_the_scan(exported, build, column):
    plan = _plan(build(exported))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert f"GreaterThanOrEqual({column}" in pushed


def test_scan_reads_only_needed_columns(exported):
    plan = _plan(ondemand.filter_ondemand_jobs(exported.jobs).select("project_id"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(c.split(":")[0] for c in schema.split(",")) == {"project_id", "reservation_id", "statement_type"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_udf(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas", plan)


def test_slot_rollups_shuffle_once(exported):
    df = slots.slot_job_hours(slots.slot_minute(slots.slot_second(slots.recent_timeline(exported.jobs_timeline, A))))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    exchanges = re.findall(r"Exchange (\w+)", df._jdf.queryExecution().executedPlan().toString())
    assert plan  # planned
    # one placement by the job keys serves the second, minute and job roll-ups
    assert len(exchanges) == 1, exchanges


def test_query_analysis_shuffles(spark, exported):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the plan a large input gets
    try:
        df = jobs.query_analysis_rows(exported.jobs, exported.job_text, A)
        exchanges = re.findall(r"Exchange hashpartitioning\((\w+)", _plan(df))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # jobs placed once by the join keys (reused by the eight-key roll-up and the
    # join), job text once (reused by the left join), and the selected job keys
    assert len(exchanges) == 3, exchanges


@pytest.mark.parametrize("build", [
    lambda t: jobs.query_analysis_rows(t.jobs, t.job_text, A),
    lambda t: slots.slot_analysis_rows(t.jobs, t.jobs_timeline, t.job_text, A),
])
def test_job_text_gets_a_runtime_bloom_filter(spark, exported, build):
    """With job text large enough (threshold lowered here), Spark filters it by
    the selected jobs' keys before shuffling it."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        optimized = build(exported)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "might_contain" in optimized


@pytest.fixture(scope="module")
def day_partitioned(spark, tmp_path_factory):
    """Jobs and timeline exported by UTC day, as a large deployment would."""
    from pyspark.sql import functions as F

    root = str(tmp_path_factory.mktemp("export_by_day"))
    t = fixtures.telemetry(spark, SF_SMALL)
    t.jobs.withColumn("start_date", F.to_date("start_time")).write.partitionBy("start_date").parquet(
        f"{root}/jobs")
    t.jobs_timeline.withColumn("period_date", F.to_date("period_start")).write.partitionBy("period_date").parquet(
        f"{root}/jobs_timeline")
    for name in TABLES:
        if name not in ("jobs", "jobs_timeline"):
            getattr(t, name).write.parquet(f"{root}/{name}")
    return read_telemetry(spark, root), t


@pytest.mark.parametrize("build,part", [
    (lambda t: editions.filter_month_window(t.jobs_timeline, A), "period_date"),
    (lambda t: jobs.filter_recent_window(t.jobs, "start_time", A), "start_date"),
    (lambda t: slots.recent_timeline(t.jobs_timeline, A), "period_date"),
])
def test_day_partitions_are_pruned(day_partitioned, build, part):
    exported, _ = day_partitioned
    plan = _plan(build(exported))
    parts = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert part in parts


def test_pruning_keeps_results(day_partitioned):
    exported, t = day_partitioned
    a = sorted(tuple(r) for r in slots.slot_job_hours(slots.slot_minute(slots.slot_second(
        slots.recent_timeline(exported.jobs_timeline, A)))).collect())
    b = sorted(tuple(r) for r in slots.slot_job_hours(slots.slot_minute(slots.slot_second(
        slots.recent_timeline(t.jobs_timeline, A)))).collect())
    assert a == b and len(a) > 0
    cols = [c for c in t.jobs.columns]
    a = sorted(tuple(r) for r in jobs.filter_recent_window(exported.jobs, "start_time", A).select(*cols).collect())
    b = sorted(tuple(r) for r in jobs.filter_recent_window(t.jobs, "start_time", A).collect())
    assert a == b


def test_mart_reads_prune_partitions(spark, tmp_path):
    from costbook.operators import sinks, storage

    daily = fixtures.daily_storage_history(fixtures.read_driver_table(spark, SF_SMALL, "events"))
    path = str(tmp_path / "daily")
    sinks.append(daily, sinks.DAILY_STORAGE_USAGE, path)
    plan = _plan(storage.storage_month_avg(sinks.read(spark, sinks.DAILY_STORAGE_USAGE, path), A))
    parts = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert "date" in parts and "2024-01-01" in parts and "2024-02-01" in parts
    sa = str(tmp_path / "sa")
    sinks.ensure(spark, sinks.STORAGE_ANALYSIS, sa)
    from datetime import date
    row = ("p", "d", "LOGICAL") + (1.0,) * 12 + (date(2024, 1, 28), "2024-01", "2024")
    sinks.append(spark.createDataFrame([row], sinks.STORAGE_ANALYSIS.schema), sinks.STORAGE_ANALYSIS, sa)
    plan = _plan(storage.storage_prev_day(sinks.read(spark, sinks.STORAGE_ANALYSIS, sa), A))
    assert "2024-01-29" in re.search(r"PartitionFilters: \[(.*?)\]", plan).group(1)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("layout", [lambda d: d.repartition(1), lambda d: d.repartition(7),
                                    lambda d: d.orderBy(F.rand(3)).repartition(5)])
def test_rollups_do_not_depend_on_row_order(spark, layout):
    t = fixtures.telemetry(spark, SF_SMALL)
    base_tl = slots.recent_timeline(t.jobs_timeline, A)
    ref = _rows(slots.slot_job_hours(slots.slot_minute(slots.slot_second(base_tl))))
    got = _rows(slots.slot_job_hours(slots.slot_minute(slots.slot_second(layout(base_tl)))))
    assert ref == got
    job = editions.edition_jobs(t.jobs_timeline, A)
    res = editions.reservation_minutes(job.select("reservation_id").distinct(), t.reservation_timeline,
                                       t.reservations, minute_range=A.month_window_utc(0))
    ref = _rows(editions.edition_slot_minute(editions.minute_totals(job), res))
    got = _rows(editions.edition_slot_minute(editions.minute_totals(layout(job)), layout(res)))
    assert ref == got


def test_broadcast_if_small(spark):
    from costbook.operators.lookups import broadcast_if_small

    small = spark.range(10)
    assert "ResolvedHint" in small.hint("broadcast")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in broadcast_if_small(small)._jdf.queryExecution().analyzed().toString().lower()
    big = spark.range(50)
    assert "broadcast" not in broadcast_if_small(big, max_bytes=100)._jdf.queryExecution().analyzed().toString().lower()


def test_reservation_timeline_is_not_shuffled_by_project(spark, exported):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = exported
        plan = _plan(editions.editions_source(t.jobs_timeline, t.reservation_timeline, t.reservations,
                                              t.price_compute, A))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not re.search(r"hashpartitioning\(project_id#\d+, project_number", plan)
    assert "BroadcastHashJoin" in plan


def test_slot_analysis_shuffles_each_input_once(spark, exported):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = exported
        plan = _plan(slots.slot_analysis_rows(t.jobs, t.jobs_timeline, t.job_text, A))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#\d+, (\w+)#\d+, (\w+)", plan)
    # timeline, jobs and text by the job keys, once each
    assert [e[2] for e in exchanges] == ["user_email"] * 3, exchanges


def test_query_analysis_scans_the_jobs_export_once(spark, exported):
    """With Bloom filters on: the staged window feeds everything, the export is not in the plan."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        files = jobs.query_analysis_rows(exported.jobs, exported.job_text, A).inputFiles()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert not any("/jobs/" in f for f in files) and any("recent-jobs" in f for f in files)


def test_only_the_window_s_days_are_listed(spark, tmp_path):
    """Neither an export nor a mart lists other days than those asked for."""
    from datetime import date, timedelta

    from costbook.operators import sinks
    from costbook.sources.telemetry import export, read_table

    root = str(tmp_path)
    t = fixtures.telemetry(spark, SF_SMALL)
    t.jobs.withColumn("start_date", F.to_date("start_time")).write.partitionBy("start_date").parquet(f"{root}/jobs")
    lo, hi = A.recent_window()
    df = read_table(spark, root, "jobs", "start_time", (lo, hi))
    days = {f.split("start_date=")[1][:10] for f in df.inputFiles()}
    assert days and days <= {(lo.date() + timedelta(days=k)).isoformat() for k in range(3)}
    assert len(read_table(spark, root, "jobs").inputFiles()) > len(df.inputFiles())
    for name in TABLES:
        if name != "jobs":
            getattr(t, name).write.parquet(f"{root}/{name}")
    one = export(spark, root, A)("query_analysis")
    whole = jobs.recent_jobs(t.jobs, A)
    assert jobs.recent_jobs(one.jobs, A).count() == whole.count() > 0

    mart = f"{root}/mart"
    sinks.append(fixtures.daily_storage_history(fixtures.read_driver_table(spark, SF_SMALL, "events")),
                 sinks.DAILY_STORAGE_USAGE, mart)
    day = sinks.read(spark, sinks.DAILY_STORAGE_USAGE, mart, [date(2024, 1, 5)])
    assert {f.split("/date=")[1][:10] for f in day.inputFiles()} == {"2024-01-05"}
    assert sinks.read(spark, sinks.DAILY_STORAGE_USAGE, mart, [date(1999, 1, 1)]).count() == 0


def test_a_job_created_after_its_start_is_kept(spark, tmp_path):
    """Only the day of the filtered column prunes."""
    from datetime import datetime

    from costbook import schemas
    from helpers import job

    root = str(tmp_path)
    rows = spark.createDataFrame([job(start=datetime(2024, 1, 29, 12), created=datetime(2024, 1, 31, 1))], schemas.JOBS)
    from costbook.sources.telemetry import read_table

    rows.withColumn("creation_date", F.to_date("creation_time")).write.partitionBy("creation_date").parquet(f"{root}/jobs")
    assert jobs.recent_jobs(read_table(spark, root, "jobs"), A).count() == 1

"""The seven pipelines run together: each on its own, appends grow, merges stay put."""

import pytest

from conftest import SF_SMALL
from costbook.asof import DEFAULT_ASOF
from costbook.operators import sinks
from costbook.plans.pipelines import SkippedError, register_mart_views, run_daily
from costbook.sources import fixtures
from costbook.sources.fanin import PerProject


def _counts(spark, run):
    return {n: sinks.read(spark, sinks.MARTS[n], p).count() for n, p in run.paths.items()}


def test_two_days_with_a_failing_merge(spark, tmp_dir):
    t = fixtures.telemetry(spark, SF_SMALL)
    run = run_daily(spark, t, DEFAULT_ASOF, tmp_dir)
    assert run.errors == {}
    counts = _counts(spark, run)
    assert all(c > 0 for c in counts.values()), counts
    # on this data the editions merge fails on the second day (repeated keys); the six others run
    nxt = DEFAULT_ASOF.shifted(days=1)
    second = run_daily(spark, t, nxt, tmp_dir)
    assert list(second.errors) == ["daily_editions_compute_pricing"]
    assert isinstance(second.errors["daily_editions_compute_pricing"], sinks.MergeError)
    after = _counts(spark, second)
    for name in ("daily_editions_compute_pricing", "daily_ondemand_compute_pricing", "monthly_storage_pricing"):
        assert after[name] == counts[name]
    for name in ("daily_storage_usage", "storage_analysis"):
        assert after[name] == 2 * counts[name]
    for name in ("query_analysis", "slot_analysis"):
        assert after[name] > counts[name]

    assert sorted(register_mart_views(spark, tmp_dir)) == sorted(sinks.MARTS)
    assert spark.sql("SELECT count(*) FROM slot_analysis").collect()[0][0] == after["slot_analysis"]
    # day two's differences are taken against day one: nothing changed, so all zero
    day2 = sinks.read(spark, sinks.STORAGE_ANALYSIS, run.paths["storage_analysis"], [nxt.today])
    assert {r[0] for r in day2.select("diff_logic_active").distinct().collect()} == {0.0}


def test_sources_by_project_strict_and_skipped(spark, tmp_dir):
    t = fixtures.telemetry(spark, SF_SMALL)
    root = f"{tmp_dir}/by"
    columns = {"reservation_timeline": "project_id", "job_text": "project_id", "schema_options": "catalog_name"}
    sources = {}
    for name, column in columns.items():
        rows = getattr(t, name)
        if name == "reservation_timeline":
            rows = rows.filter("project_id != 'admin-a'")
        rows.withColumn("key", rows[column]).write.partitionBy("key").parquet(f"{root}/{name}")
        sources[name] = PerProject(spark, f"{root}/{name}/key={{key}}", rows.schema)
    run = run_daily(spark, t.with_(**sources), DEFAULT_ASOF, f"{tmp_dir}/marts")
    # an administration project without a timeline stops the editions run, and only that
    assert list(run.errors) == ["daily_editions_compute_pricing"]
    assert "admin-a" in str(run.errors["daily_editions_compute_pricing"])
    assert set(run.skipped) == {"daily_storage_usage", "storage_analysis"}
    assert set(run.skipped["daily_storage_usage"]) == {"proj-6"}


def test_monthly_price_is_left_out_when_the_daily_storage_run_fails(spark, tmp_dir):
    t = fixtures.telemetry(spark, SF_SMALL)
    run = run_daily(spark, t.with_(table_storage=t.table_storage.drop("project_id")), DEFAULT_ASOF, tmp_dir)
    assert set(run.errors) == {"daily_storage_usage", "storage_analysis", "monthly_storage_pricing"}
    assert isinstance(run.errors["monthly_storage_pricing"], SkippedError)


def test_daily_command_line(spark, tmp_dir, capsys):
    from costbook.plans import daily
    from costbook.sources.telemetry import TABLES

    t = fixtures.telemetry(spark, SF_SMALL)
    for name in TABLES:
        getattr(t, name).write.parquet(f"{tmp_dir}/export/{name}")
    args = ["--telemetry", f"{tmp_dir}/export", "--marts", f"{tmp_dir}/marts", "--asof"]
    daily.main([*args, "2024-01-29T21:00:00"])
    printed = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert set(printed) == set(sinks.MARTS)
    assert sinks.read(spark, sinks.SLOT_ANALYSIS, printed["slot_analysis"]).count() > 0
    with pytest.raises(SystemExit) as status:
        daily.main([*args, "2024-01-30T21:00:00"])
    assert status.value.code == 1
    lines = [x for x in capsys.readouterr().out.splitlines() if "FAILED" in x]
    assert len(lines) == 1 and lines[0].startswith("daily_editions_compute_pricing\tFAILED\tMergeError")

"""Month-to-date runs from partial sums kept per day."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from costbook.asof import DEFAULT_ASOF as A
from costbook.constants import EXCLUDED_RESERVATION
from costbook.operators import partials, sinks
from costbook.plans import pipelines
from costbook.sources import fixtures

PARTS = {"jobs": ("creation_time", "creation_date"), "jobs_timeline": ("period_start", "period_date"),
         "reservation_timeline": ("period_start", "period_date")}


def export(spark, root, t):
    for name, (column, part) in PARTS.items():
        getattr(t, name).withColumn(part, F.to_date(column)).write.partitionBy(part).mode("append").parquet(f"{root}/{name}")
    for name in ("reservations", "price_compute"):
        getattr(t, name).write.mode("overwrite").parquet(f"{root}/{name}")


def full(spark, root, mart):
    from costbook.sources.telemetry import TABLES, read_table
    t = fixtures.telemetry(spark, SF_SMALL).with_(**{n: read_table(spark, root, n) for n in TABLES if os.path.exists(f"{root}/{n}")})
    path = f"{root}-full-{mart.name}-{len(os.listdir(os.path.dirname(root)))}"
    run = {"daily_editions_compute_pricing": pipelines.run_editions_day_pricing,
           "daily_ondemand_compute_pricing": pipelines.run_ondemand_day_pricing}[mart.name]
    run(t, A, path)
    return rows(spark, mart, path)


def rows(spark, mart, path):
    return sorted(map(tuple, sinks.read(spark, mart, path).collect()), key=repr)


def spoil(root, name, part, but):
    """Overwrite the files of every other day by bytes that are no Parquet, times and lengths as before:
    reading any of them fails."""
    n = 0
    for folder in os.listdir(f"{root}/{name}"):
        if not folder.startswith(part) or folder.split("=")[1] in but:
            continue
        for f in os.listdir(f"{root}/{name}/{folder}"):
            at = f"{root}/{name}/{folder}/{f}"
            if f.endswith(".parquet"):
                was = os.stat(at)
                with open(at, "wb") as fh:
                    fh.write(b"x" * was.st_size)
                os.utime(at, ns=(was.st_atime_ns, was.st_mtime_ns))
                n += 1
    return n


RUNS = {
    "ondemand": (sinks.DAILY_ONDEMAND_COMPUTE_PRICING, pipelines.run_ondemand_day_pricing_kept, ["jobs"]),
    "editions": (sinks.DAILY_EDITIONS_COMPUTE_PRICING, pipelines.run_editions_day_pricing_kept, ["jobs_timeline", "reservation_timeline"]),
}


@pytest.mark.parametrize("which", sorted(RUNS))
def test_a_late_row_reads_its_day_only(spark, tmp_path, which):
    mart, run, names = RUNS[which]
    root, kept = str(tmp_path / "export"), str(tmp_path / "kept")
    t = fixtures.telemetry(spark, SF_SMALL)
    export(spark, root, t)
    first = run(spark, root, A, str(tmp_path / "m1"), kept)
    assert len(first) > 10 and rows(spark, mart, str(tmp_path / "m1")) == full(spark, root, mart)
    assert run(spark, root, A, str(tmp_path / "m2"), kept) == []
    assert rows(spark, mart, str(tmp_path / "m2")) == rows(spark, mart, str(tmp_path / "m1"))
    # a late row on an old day
    day = first[len(first) // 2]
    name, (column, part) = names[0], PARTS[names[0]]
    late = getattr(t, name).filter(F.to_date(column) == F.lit(day.isoformat()).cast("date"))
    if which == "ondemand":
        much = {"total_bytes_billed": F.lit(10**13), "reservation_id": F.lit(None).cast("string")}
    else:  # a minute that the reservation timeline has
        late = late.filter(F.col("reservation_id") != EXCLUDED_RESERVATION)
        much = {"period_slot_ms": F.lit(10**10), "job_creation_time": F.col("period_start")}
    late = late.limit(1).withColumns(much).withColumn("statement_type", F.lit("SELECT"))
    assert late.count() == 1
    late.withColumn(part, F.to_date(column)).write.partitionBy(part).mode("append").parquet(f"{root}/{name}")
    expected = full(spark, root, mart)
    assert expected != rows(spark, mart, str(tmp_path / "m1"))
    assert sum(spoil(root, n, PARTS[n][1], {day.isoformat()}) for n in names) > 10
    assert run(spark, root, A, str(tmp_path / "m3"), kept) == [day]
    assert rows(spark, mart, str(tmp_path / "m3")) == expected


def test_a_day_that_loses_its_rows_and_a_stopped_refresh(spark, tmp_path):
    from costbook import schemas
    kept = partials.KeptDays(spark, str(tmp_path / "kept"), schemas.ONDEMAND_DAY_PARTIAL)
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)

    def build(n):
        return lambda days: spark.createDataFrame([("p", d, n, d) for d in days if n], schemas.ONDEMAND_DAY_PARTIAL)

    assert kept.refresh({d1: "a", d2: "a"}, build(1)) == [d1, d2]
    assert kept.refresh({d1: "a", d2: "b"}, build(0)) == [d2]
    assert [tuple(r) for r in kept.read([d1, d2]).collect()] == [("p", d1, 1, d1)]
    with pytest.raises(ZeroDivisionError):
        kept.refresh({d1: "c", d2: "b"}, lambda days: 1 / 0)
    assert kept.refresh({d1: "c", d2: "b"}, build(5)) == [d1]  # the stopped run left it without a print
    assert [tuple(r) for r in kept.read([d1, d2]).collect()] == [("p", d1, 5, d1)]


def test_prints_name_files_and_dependencies(spark, tmp_path):
    t = fixtures.telemetry(spark, SF_SMALL)
    export(spark, str(tmp_path), t)
    days = partials.DayExport(spark, str(tmp_path), {"jobs": "creation_time"}, A.month_window_utc(1))
    assert days.prints("x") == days.prints("x") and set(days.prints("x").values()).isdisjoint(days.prints("y").values())
    assert partials.rows_digest(t.reservations) == partials.rows_digest(t.reservations.repartition(3))
    assert partials.rows_digest(t.reservations) != partials.rows_digest(t.reservations.limit(1))

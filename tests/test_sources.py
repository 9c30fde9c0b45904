"""Export readers."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from costbook.sources import fixtures
from costbook.sources.telemetry import read_table


def test_zoned_timestamps_in_an_export_read_as_utc_wall_clock(spark, tmp_dir):
    """Exports usually hold UTC-adjusted (zoned) timestamps; the reader turns
    them into the UTC wall clock whatever zone the session had."""
    jobs = fixtures.telemetry(spark, SF_SMALL).jobs
    expected = sorted(tuple(r) for r in jobs.collect())
    zoned = jobs.select(*[F.col(c).cast("timestamp").alias(c) if c.endswith("_time") else F.col(c)
                          for c in jobs.columns])
    zoned.write.parquet(f"{tmp_dir}/jobs")  # written under UTC
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        back = read_table(spark, tmp_dir, "jobs")
        assert back.schema["start_time"].dataType.simpleString() == "timestamp_ntz"
        assert sorted(tuple(r) for r in back.collect()) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_optional_columns_are_kept_when_present(spark, tmp_dir):
    t = fixtures.telemetry(spark, SF_SMALL)
    t.reservations.write.parquet(f"{tmp_dir}/reservations")
    assert "reservation_name" in read_table(spark, tmp_dir, "reservations").columns
    t.reservations.drop("reservation_name").write.parquet(f"{tmp_dir}/r2/reservations")
    assert "reservation_name" not in read_table(spark, f"{tmp_dir}/r2", "reservations").columns

"""Gathering per-project sources."""

import pytest

from costbook import schemas
from costbook.sources.fanin import FanInError, fan_in
from helpers import frame


def _write(spark, path, rows):
    frame(spark, schemas.SCHEMA_OPTIONS, rows).write.parquet(path)


def test_strict_and_skip(spark, tmp_dir):
    _write(spark, f"{tmp_dir}/a", [("a", "d1", "storage_billing_model", "PHYSICAL")])
    _write(spark, f"{tmp_dir}/empty", [])
    with open(f"{tmp_dir}/corrupt.parquet", "wb") as fh:
        fh.write(b"not a parquet file at all")
    sources = {"a": f"{tmp_dir}/a", "empty": f"{tmp_dir}/empty", "missing": f"{tmp_dir}/nope",
               "corrupt": f"{tmp_dir}/corrupt.parquet"}
    with pytest.raises(FanInError):
        fan_in(spark, sources, schemas.SCHEMA_OPTIONS, on_error="raise")
    res = fan_in(spark, sources, schemas.SCHEMA_OPTIONS, on_error="skip")
    assert res.frame.count() == 1
    assert set(res.skipped) == {"missing", "corrupt"}
    assert "a" in res.read
    ok = fan_in(spark, {"a": f"{tmp_dir}/a"}, schemas.SCHEMA_OPTIONS, on_error="raise")
    assert ok.frame.columns == [f.name for f in schemas.SCHEMA_OPTIONS.fields]


def test_no_readable_source_gives_empty_frame(spark, tmp_dir):
    res = fan_in(spark, {"x": f"{tmp_dir}/none"}, schemas.SCHEMA_OPTIONS, on_error="skip")
    assert res.frame.count() == 0 and res.skipped == {"x": res.skipped["x"]}


def test_many_sources_checked_in_parallel(spark, tmp_dir):
    frame(spark, schemas.SCHEMA_OPTIONS, [("p", "d", "storage_billing_model", "LOGICAL")]).write.parquet(
        f"{tmp_dir}/one")
    sources = {f"p{i:02d}": (f"{tmp_dir}/one" if i % 5 else f"{tmp_dir}/missing{i}") for i in range(40)}
    res = fan_in(spark, sources, schemas.SCHEMA_OPTIONS, on_error="skip", parallelism=8)
    assert res.frame.count() == 32
    assert sorted(res.skipped) == [f"p{i:02d}" for i in range(0, 40, 5)]
    with pytest.raises(FanInError, match="'p00'"):
        fan_in(spark, sources, schemas.SCHEMA_OPTIONS, on_error="raise", parallelism=8)


def test_one_corrupt_or_odd_file_makes_a_source_unreadable(spark, tmp_dir):
    for name in ("half", "odd", "good"):
        _write(spark, f"{tmp_dir}/{name}", [(name, "d", "storage_billing_model", "LOGICAL")])
    with open(f"{tmp_dir}/half/part-zz-corrupt.parquet", "wb") as fh:
        fh.write(b"garbage that is not parquet")
    spark.range(3).selectExpr("id AS catalog_name", "'d' AS schema_name", "'o' AS option_name", "'v' AS option_value").write.mode(
        "append").parquet(f"{tmp_dir}/odd")
    sources = {k: f"{tmp_dir}/{k}" for k in ("half", "odd", "good")}
    res = fan_in(spark, sources, schemas.SCHEMA_OPTIONS, on_error="skip")
    assert set(res.skipped) == {"half", "odd"} and res.frame.count() == 1
    with pytest.raises(FanInError):
        fan_in(spark, sources, schemas.SCHEMA_OPTIONS, on_error="raise")

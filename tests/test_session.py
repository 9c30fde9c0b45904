"""Session helpers."""

import pytest

from conftest import SF_SMALL
from costbook.session import CLUSTER_CONF, Staging, remove_path, require_utc, scratch_path, scratch_root
from costbook.sources import fixtures


def test_telemetry_pins_the_session_zone_to_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        fixtures.telemetry(spark, SF_SMALL)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        require_utc(spark)
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        with pytest.raises(ValueError, match="UTC"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scratch_is_below_the_checkpoint_dir(spark):
    root = scratch_root(spark)
    assert root.rstrip("/") == spark.sparkContext.getCheckpointDir().rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)


def test_scratch_needs_a_shared_folder_off_local_masters():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session())


def test_staging_removes_what_it_wrote(spark):
    import os

    with Staging(spark) as staging:
        df = staging.table(spark.range(5), "five")
        assert df.count() == 5
        path = staging.paths[0].removeprefix("file:")
        assert os.path.isdir(path)
    assert not os.path.exists(path)
    with pytest.raises(ValueError):
        remove_path(spark, "/somewhere/else")


def test_cluster_settings_keep_adaptive_execution_on():
    assert CLUSTER_CONF["spark.sql.adaptive.enabled"] == "true"
    assert CLUSTER_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert CLUSTER_CONF["spark.sql.session.timeZone"] == "UTC"

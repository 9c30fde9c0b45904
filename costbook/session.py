"""Session helpers: local test sessions and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Settings for a large cluster (apply with SparkSession.builder.config(map=...)).
# AQE sizes the shuffles at run time, coalesces small partitions, splits
# skewed ones and turns a join into a broadcast only when a side measured at
# run time is small; Bloom filters trim the job-text scan to the selected jobs.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # a day of selected jobs is far above the 10 MB default creation side; a
    # filter of tens of millions of job keys is still only tens of MB of bits
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "100000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "536870912",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpoints of a finished run are dropped once their frames are gone;
    # staged merge sources stay below spark.checkpoint.dir for its retention
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "costbook") -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("COSTBOOK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def require_utc(spark: SparkSession) -> None:
    """Raise unless the session zone is UTC.

    Telemetry instants are ``timestamp_ntz`` values holding UTC.  Most
    functions used on them are zone-free, but ``timestamp_diff`` and
    ``date_trunc`` accept only zoned timestamps and convert through the
    session zone; only under UTC is that conversion exact.  The caller's
    setting is not changed.
    """
    zone = spark.conf.get("spark.sql.session.timeZone", None)
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT"):
        raise ValueError(f"the pipelines need spark.sql.session.timeZone=UTC, not {zone}")


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[n]``)."""
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables and checkpoints.

    This is ``spark.checkpoint.dir`` as the deployment names it.  Only a local
    master without the setting gets a fresh folder of this machine; on several
    machines such a folder would lose rows, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not is_local(sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="costbook-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that this library has written below the scratch root."""
    if not path.startswith(scratch_root(spark)):
        raise ValueError(f"{path} is not below the scratch root")
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


class Staging:
    """Tables written below the scratch root for one run, and removed after it.

    As a context manager it deletes its folders at the end; used without
    ``with`` (a lazy result that is read later) they stay for the retention of
    the scratch root.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and read it back: computed once, with statistics."""
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> str:
        """The folder of the last table, which this run's end no longer deletes."""
        return self.paths.pop()

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *exc) -> None:
        for path in self.paths:
            remove_path(self.spark, path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"

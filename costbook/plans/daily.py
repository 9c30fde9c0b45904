"""Command line: run the seven daily pipelines once.

    spark-submit -m costbook.plans.daily --telemetry /exports --marts /marts \
        --asof 2024-01-29T21:00:00

Telemetry is read from ``--telemetry`` (one folder per view, see
``costbook.sources.telemetry.TABLES``); ``--scratch`` names a folder that all
executors share, unless ``spark.checkpoint.dir`` does.  Without ``--asof``
nothing runs: the clock is always explicit (``now`` prints the instant it
took), so a rerun is reproducible.  Marts that failed are listed with their
error, and the exit status is then 1.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from pyspark import SparkConf
from pyspark.sql import SparkSession

from costbook.asof import DEFAULT_REGION, DEFAULT_ZONE, AsOf
from costbook.plans.pipelines import run_daily
from costbook.session import CLUSTER_CONF, is_local
from costbook.sources.telemetry import export


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--telemetry", required=True)
    ap.add_argument("--marts", required=True)
    ap.add_argument("--asof", required=True,
                    help="UTC instant, ISO format; 'now' takes the current instant (printed, so a rerun can repeat it)")
    ap.add_argument("--zone", default=DEFAULT_ZONE)
    ap.add_argument("--region", default=DEFAULT_REGION)
    ap.add_argument("--scratch", help="folder shared by all executors, for staged tables")
    args = ap.parse_args(argv)
    spark = _session(args.scratch)
    if args.asof == "now":
        args.asof = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0).isoformat()
        print(f"asof\t{args.asof}")
    asof = AsOf.parse(args.asof, args.zone, args.region)
    run = run_daily(spark, export(spark, args.telemetry, asof), asof, args.marts)
    for name, path in run.paths.items():
        error = run.errors.get(name)
        print(f"{name}\t{path}" if error is None else f"{name}\tFAILED\t{type(error).__name__}: {str(error).splitlines()[0]}")
        for project, why in run.skipped.get(name, {}).items():
            print(f"{name}\tskipped\t{project}\t{why}")
    if run.errors:
        sys.exit(1)


def _session(scratch: str | None) -> SparkSession:
    """The session of the submit; off local masters with the settings for a large cluster."""
    given = SparkConf()
    builder = SparkSession.builder.appName("costbook-daily").config("spark.sql.session.timeZone", "UTC")
    if not is_local(given.get("spark.master", "local")):
        builder = builder.config(map={k: v for k, v in CLUSTER_CONF.items() if not given.contains(k)})
    if scratch:
        builder = builder.config("spark.checkpoint.dir", scratch)
    spark = builder.getOrCreate()
    if scratch:
        spark.sparkContext.setCheckpointDir(scratch)
    return spark


if __name__ == "__main__":
    main()

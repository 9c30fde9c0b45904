"""Physical-plan summary of the seven pipelines, as a large input would get it.

    python tools/plan_report.py [sf_dir] > docs/PLANS.md

The fixture telemetry is written as an export laid out by day
(``creation_date`` / ``period_date``), read back with the readers, and each
pipeline's source DataFrame is planned with size-based broadcasts switched off
(the small test tables would otherwise all be broadcast).  For every plan the
report lists the scans (pushed and partition filters, columns read), the
exchanges, joins and aggregates.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from costbook.asof import DEFAULT_ASOF as A  # noqa: E402
from costbook.operators import sinks  # noqa: E402
from costbook.plans import pipelines as P  # noqa: E402
from costbook.session import local_session  # noqa: E402
from costbook.sources import fixtures  # noqa: E402
from costbook.sources.telemetry import TABLES, read_telemetry  # noqa: E402


def export(spark, sf_dir, root):
    t = fixtures.telemetry(spark, sf_dir)
    t.jobs.withColumn("creation_date", F.to_date("creation_time")).write.partitionBy("creation_date").parquet(
        f"{root}/jobs")
    t.jobs_timeline.withColumn("period_date", F.to_date("period_start")).write.partitionBy("period_date").parquet(
        f"{root}/jobs_timeline")
    for name in TABLES:
        if name not in ("jobs", "jobs_timeline"):
            getattr(t, name).write.parquet(f"{root}/{name}")
    daily = f"{root}/mart_daily_storage_usage"
    sinks.append(fixtures.daily_storage_history(fixtures.read_driver_table(spark, sf_dir, "events")),
                 sinks.DAILY_STORAGE_USAGE, daily)
    sa = f"{root}/mart_storage_analysis"
    sinks.ensure(spark, sinks.STORAGE_ANALYSIS, sa)
    return read_telemetry(spark, root), daily, sa


def summarize(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        s = re.sub(r"^\*\(\d+\)\s*", "", line.strip().lstrip(":+- ").strip())
        if s.startswith("FileScan parquet") or s.startswith("Scan parquet"):
            loc = re.search(r"Location: \w+\(\d+ paths\)\[([^\]]*)\]", s)
            name = loc.group(1).rstrip("/").split("/")[-1] if loc else "?"
            pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", s)
            parts = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", s)
            schema = re.search(r"ReadSchema: struct<(.*)>", s)
            cols = [c.split(":")[0] for c in schema.group(1).split(",")] if schema and schema.group(1) else []
            out.append(f"- scan `{name}`: columns {', '.join(cols)}")
            if parts and parts.group(1):
                out.append(f"  - partition filters: `{parts.group(1)}`")
            if pushed and pushed.group(1):
                out.append(f"  - pushed filters: `{pushed.group(1)}`")
        elif s.startswith("Exchange"):
            kind = re.match(r"Exchange (\w+\(?[^,\)]*)", s)
            keys = re.search(r"hashpartitioning\((.*?), \d+\)", s)
            label = f"hash({re.sub(r'#[0-9L]+', '', keys.group(1))})" if keys else s.split(",")[0]
            origin = "REPARTITION_BY_COL" if "REPARTITION_BY_COL" in s else "required"
            out.append(f"- exchange {label} ({origin})")
        elif re.match(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", s):
            kind = s.split(" ")[0]
            jt = re.search(r"(Inner|LeftOuter|RightOuter|FullOuter|LeftSemi|LeftAnti)", s)
            out.append(f"- join {kind} {jt.group(1) if jt else ''}")
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    root = tempfile.mkdtemp(prefix="costbook-plans-")
    t, daily, sa = export(spark, sf_dir, root)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan, before run-time re-planning
    plans = {
        "P1 editions_day_pricing": lambda: P.editions_day_pricing_source(t, A),
        "P2 ondemand_day_pricing": lambda: P.ondemand_day_pricing_source(t, A),
        "P3 daily_storage_usage": lambda: P.daily_storage_usage_source(t, A),
        "P4 monthly_storage_pricing": lambda: P.monthly_storage_pricing_source(
            sinks.read(spark, sinks.DAILY_STORAGE_USAGE, daily), t, A),
        "P5 query_analysis": lambda: P.query_analysis_source(t, A),
        "P6 slot_analysis": lambda: P.slot_analysis_source(t, A),
        "P7 storage_analysis": lambda: P.storage_analysis_source(spark, t, A, sa),
    }
    print("# Physical plans of the seven pipelines\n")
    print("Generated by `python tools/plan_report.py`: telemetry exported by day, size-based broadcast off, "
          "AQE off (the static plan; at run time AQE may still turn a measured-small side into a broadcast and "
          "coalesce or split partitions).  Price lookups are scalar subqueries over the price list and are not "
          "listed.  P1's per-minute totals are checkpointed first; their scan is `Scan ExistingRDD`.\n")
    for name, build in plans.items():
        df = build()
        plan = df._jdf.queryExecution().executedPlan().toString()
        main_plan = plan.split("Subquery subquery")[0] if "Subquery subquery" in plan else plan
        lines = summarize(plan)
        ex = sum(1 for x in lines if x.startswith("- exchange"))
        print(f"## {name}\n")
        print(f"{ex} exchanges; no Python UDF: {not re.search('PythonUDF|EvalPython', plan)}\n")
        print("\n".join(lines) + "\n")
        del main_plan


if __name__ == "__main__":
    main(sys.argv)

"""Bench: wall time of the headline queries at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  Each query is timed end to end (plan, run, and for the
pipelines the mart write; seeding a mart beforehand is not timed), after one untimed warm-up run of the whole set;
the reported time per query is the median of ``BENCH_RUNS`` (default 3) runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from costbook.session import local_session  # noqa: E402
from costbook.plans import registry  # noqa: E402

# The seven scheduled pipelines (source, roll-ups and sink) plus the largest
# single operators.
HEADLINE = [
    "editions_day_pricing",
    "ondemand_day_pricing",
    "daily_storage_usage",
    "monthly_storage_pricing",
    "query_analysis",
    "slot_analysis",
    "storage_analysis",
    "join_timeline_reservation",
    "storage_classified",
    "upsert_ondemand",
]


def run(spark, key: str, sf_dir: str) -> float:
    if key in registry.TIMED:
        prepare, body = registry.TIMED[key]
        state = prepare(spark, sf_dir)  # fixture work: seeded marts
        t0 = time.perf_counter()
        df = body(spark, state)
    else:
        t0 = time.perf_counter()
        df = registry.QUERIES[key](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")),
                          app="costbook-bench")
    spark.sparkContext.setLogLevel("ERROR")
    for key in HEADLINE:  # warm-up: JIT, file listing caches
        run(spark, key, sf_dir)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times = {key: round(statistics.median(run(spark, key, sf_dir) for _ in range(runs)), 3) for key in HEADLINE}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Wall time of every registered query: three timed runs after one warm-up.

    python tools/time_keys.py [sf_dir] [runs]

Prints a markdown table (key, rows, min / median / max seconds).  Each run
plans and executes the query and drains it into Spark's no-op sink.
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from costbook.plans.registry import QUERIES  # noqa: E402
from costbook.session import local_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    runs = int(argv[2]) if len(argv) > 2 else 3
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    print(f"| key | rows | min s | median s | max s |\n|---|---|---|---|---|")
    for key, fn in QUERIES.items():
        rows = fn(spark, sf_dir).count()  # warm-up
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        print(f"| {key} | {rows} | {min(times):.2f} | {statistics.median(times):.2f} | {max(times):.2f} |",
              flush=True)


if __name__ == "__main__":
    main(sys.argv)

"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is executed to completion with the ``noop`` sink (all rows
produced, nothing collected to the driver); the median of its runs counts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from featurelake.plans import catalog  # noqa: E402
from featurelake.session import build_session  # noqa: E402

HEADLINE = [
    "combined_interactions",
    "prepared_interactions",
    "user_features",
    "item_features",
    "interaction_features",
    "dq_summary",
    "dq_failures",
    "rating_distribution",
    "top_items",
    "lineage_fingerprint",
    "speed_table",
    "rating_cells",
    "svd_metrics",
    "svd_top_k",
    "baseline_kde",
    "lambda_job",
]
# a query is timed REPEATS times, but not again once SPENT seconds are used
REPEATS, SPENT = 3, 30.0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    # one process on one machine: a folder of its own is shared by all there is
    scratch = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                 "spark.checkpoint.dir": scratch})
    # JVM / JIT warm-up on the smallest data set — not timed, nothing reused
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        catalog.QUERIES["user_features"](spark, warm).write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()
    times: dict[str, float] = {}
    for name in (only or HEADLINE):
        fn = catalog.QUERIES[name]
        runs: list[float] = []
        while len(runs) < REPEATS and sum(runs) < SPENT:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
            spark.catalog.clearCache()
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

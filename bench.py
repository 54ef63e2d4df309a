"""Benchmark: run the registered queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query runs once as a warm-up and then $BENCH_REPS times (default 3); the
median wall time is reported.  Queries are executed with the ``noop`` sink, so
the whole plan runs but no rows travel to the driver.  Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [key ...]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans.registry import QUERIES  # noqa: E402
from strata.session import get_session  # noqa: E402


def run_once(spark, fn, root: str) -> float:
    t = time.perf_counter()
    fn(spark, root).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    keys = sys.argv[1:] or list(QUERIES)
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus))
    times: dict[str, float] = {}
    for k in keys:
        fn = QUERIES[k]
        run_once(spark, fn, root)  # warm-up
        samples = [run_once(spark, fn, root) for _ in range(reps)]
        times[k] = round(statistics.median(samples), 3)
        print(f"# {k}: {times[k]:.3f}s", file=sys.stderr)
    headline = sum(times.values())
    sf = os.path.basename(root.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "sum_median_query_seconds",
                "value": round(headline, 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "cpus": cpus,
                "reps": reps,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

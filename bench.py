"""Benchmark of the headline queries.

Runs each query end to end (plan construction plus execution, the result
written to a no-op sink so every row is computed) on local[$BENCH_CPUS]
against $BENCH_SF_DIR, and prints one JSON line.  Each query runs
$BENCH_WARMUP times to warm up the JVM, then $BENCH_REPEAT times; the median
is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("campaign_performance", "in_store_activity", "reservation_counts", "participations_main",
            "daily_net_sales", "attribution_30d", "lineitem_ship_window", "lineitem_net_sales")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    warmup = int(os.environ.get("BENCH_WARMUP", "2"))
    from storelift.plans.queries import QUERIES
    from storelift.session import get_session

    spark = get_session(f"local[{cpus}]", int(cpus))
    times = {}
    for name in HEADLINE:
        fn = QUERIES[name]
        runs = []
        for i in range(warmup + repeat):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i >= warmup:
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
    }))


if __name__ == "__main__":
    main()

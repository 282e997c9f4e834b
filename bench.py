"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every query is executed in full with the ``noop`` sink (all rows computed,
nothing collected to the driver). ``queries`` and ``value`` are cold times: no
warm-up, and every query builds its own chain, with the written recipient side, from
scratch; only the JVM stays the same, so the first query also pays for loading
it. ``warm`` are the times of a second run that reuses the chain.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "annual_net_totals",     # flagship: recipients -> point in polygon -> filters -> spreading -> totals
    "delivery_spread",
    "city_gov_filter",
    "award_class",
    "spread_case2",
    "txn_ueis",
    "recipients_in_city",
    "point_in_polygon",
    "geocode_cascade",
    "chart_timeline",
    "top_agencies",
    "shard_union",
]


def main() -> None:
    from spendlens.plans import catalog
    from spendlens.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(app="spendlens-bench", master=f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    qs = catalog.queries()
    times: dict[str, float] = {}
    warm: dict[str, float] = {}
    for name in HEADLINE:
        catalog.forget_chains()
        for found in (times, warm):
            t = time.time()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            found[name] = round(time.time() - t, 3)
    total = round(sum(times.values()), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None, "warm": warm}))
    spark.stop()


if __name__ == "__main__":
    main()

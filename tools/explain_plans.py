"""Print the formatted physical plan of registered queries.

    python tools/explain_plans.py [sf_dir] key [key ...]

Runs each query once (so the adaptive plan is final) and prints
``explain("formatted")``-style output: scans with PushedFilters/ReadSchema,
join strategies, exchanges and aggregates.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from spendlens.plans import catalog
    from spendlens.session import build_session
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or ["annual_net_totals"]
    spark = build_session(master="local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    for k in keys:
        df = catalog.queries()[k](spark, d)
        df.write.format("noop").mode("overwrite").save()
        print(f"==== {k}")
        df.explain("formatted")


if __name__ == "__main__":
    main()

"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion through the ``noop`` sink (every row is
computed, nothing is collected to the driver) after one warm-up run of the
customer base; times are wall-clock seconds.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "customer_base",
    "rfm_features",
    "rfm_cutkeys",
    "top10_risk",
    "score_with_actual",
    "describe",
    "histogram_30",
    "boxplot_by_churn",
    "corr_matrix",
    "split_stratified",
    "class_report",
    "leaderboard",
    "rf_scores",
    "stream_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE

    from attrition.plans.catalog import QUERIES
    from attrition.session import local_session

    spark = local_session(cpus)
    QUERIES["customer_base"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up

    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

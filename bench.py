"""Benchmark the headline queries; prints one JSON line.

Every query is executed in full through the ``noop`` sink (all rows are
produced, nothing is collected to the driver).  One warm-up pass, then the
median of ``BENCH_RUNS`` timed passes per query.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (default 3), BENCH_QUERIES (comma list, or "all").
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablewright.plans.catalog import QUERIES  # noqa: E402
from tablewright.session import get_session, scratch  # noqa: E402

HEADLINE = [
    "flagship", "monthly_rate_join", "flag_summary", "missing_report", "numeric_summary",
    "group_median_topk", "regional_trend", "histogram_bins", "box_stats", "price_per_unit_median",
    "top_agents_by_month", "month_version_select", "csv_typed_scan", "new_vs_closed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else (chosen.split(",") if chosen else HEADLINE)
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    extra = dict(kv.split("=", 1) for kv in os.environ.get("BENCH_CONF", "").split(",") if kv)
    spark = get_session(f"local[{cpus}]", shuffle_partitions=parts,
                        conf={"spark.driver.memory": "16g", **extra})
    times = {}
    for name in names:
        q = QUERIES[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            with scratch(spark):
                q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # the first pass is the warm-up
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs,
                      "shuffle_partitions": parts}))


if __name__ == "__main__":
    main()

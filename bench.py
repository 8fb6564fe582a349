"""Timing of the headline queries: one warm-up, then the median of BENCH_RUNS runs of each.

Prints one JSON line. BENCH_SF_DIR names the tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from floortally import session  # noqa: E402
from floortally.bindings.registry import QUERIES  # noqa: E402

HEADLINE = [
    "topk_reason_mtd",
    "unsuccessful_total",
    "lost_sale_followups",
    "category_issue_crosstab",
    "category_wtd_mtd",
    "outcome_totals_by_tenant",
    "reason_domain_wtd_mtd",
    "objection_handling_matrix",
    "funnel_combined_total",
    "device_file_stats",
    "flagged_managers_total",
    "same_day_summary",
    "assignment_range_join",
    "adherence_bands",
    "reason_matrix",
]


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    settings = {"spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    spark = session.build("bench", f"local[{cpus}]", cpus, **settings)
    spark.sparkContext.setLogLevel("OFF")
    timed = {}
    for name in HEADLINE:
        seconds(QUERIES[name], spark, sf_dir)
        timed[name] = round(statistics.median(seconds(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    result = {
        "metric": "total seconds of the headline queries (median of warm runs)",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": float(scale.group(1).rstrip(".")) if scale else None,
        "cpus": cpus,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()

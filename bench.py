"""Time the headline queries: one JSON line on stdout."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from duebook.plans import QUERIES  # noqa: E402
from duebook.session import local_session  # noqa: E402

HEADLINE = [
    "class_shares",
    "obligation_clock",
    "backlog_history",
    "compliance",
    "segment_qa",
    "coverage_grouping_sets",
    "banded_best_match",
    "cross_register",
    "graded_match",
    "loose_dedupe",
    "html_to_marked_lines",
    "page_furniture",
    "topic_search",
    "gate_register",
    "stratified_sample",
    "burst_days",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf)}))


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS
(default 8) the local cores. Each query runs once to warm up; the reported
time is the median of the next BENCH_RUNS (default 2) runs, planning included.
All rows are produced (noop sink) and none are collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tamiz.session import local_session
from tamiz.workload.queries import QUERIES

HEADLINE = [
    "column_profile_documents", "column_profile_registry", "missing_markers",
    "unique_values", "value_frequency_orders", "minority_category_lineitem",
    "conditional_frequency", "exact_duplicates_documents", "exact_duplicates_heavy",
    "surplus_duplicates", "writing_patterns_documents", "address_markers",
    "address_redundancy", "phone_parse", "phone_classes", "name_absence_director",
    "fold_keys", "entity_variants", "fuzzy_pairs", "fd_violations_registry",
    "municipality_checks", "defect_ledger", "record_lineage", "csv_round_trip",
    "transformation_log",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus=cpus, app="bench")
    times = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

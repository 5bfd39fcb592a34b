"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   tables to read      (default /root/testdata/sf0.1)
BENCH_CPUS     cores of local[n]   (default 8)
BENCH_RUNS     timed runs per query after one untimed run (default 2, the best counts)
"""

from __future__ import annotations

import json
import os
import time

from pulsegrid.plans.catalog import QUERIES
from pulsegrid.runtime import build_session

HEADLINE = (
    "dom_summary_classic",
    "dom_summary_hits",
    "dom_summary_equinox",
    "truth_max_interpmt_distance",
    "truth_complete",
    "filter_composite",
    "filter_receipt",
    "blend_shards",
    "shape_features",
    "string_assign_box",
    "feature_stats_by_class",
)


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(cores, "pulsegrid-bench", **{"spark.sql.shuffle.partitions": cores})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        timed(spark, name, sf_dir)
        seconds[name] = round(min(timed(spark, name, sf_dir) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()

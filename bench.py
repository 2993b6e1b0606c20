"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every query is forced with the ``noop`` sink (full execution, nothing is
collected to the driver).  ``medallion_run`` is one full batch run: Silver
written once, then every Gold table computed from the written Silver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "silver_clean", "silver_quarantine", "batch_quality_stats", "dedup_content_hash",
    "repo_metrics", "repo_top_types", "contributor_metrics", "daily_series", "hourly_types",
    "top_repos", "kpis", "numeric_profile", "weekday_hour_heatmap", "key_insights",
    "incremental_new_rows", "anti_join_new_events", "run_health", "stream_hourly_counts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tidemark.plans import catalog, medallion
    from tidemark.session import local_session, work_dir

    spark = local_session(cores=cpus)
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-bench-"))
    # warm-up (JVM, codegen caches); not timed
    catalog.QUERIES["event_type_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    root = work_dir(spark, "bench", uuid.uuid4().hex)
    medallion.run_layers(spark, catalog.bronze(spark, sf_dir), root, catalog.RUN_TS)
    times["medallion_run"] = round(time.perf_counter() - t0, 3)
    cells, rows = (spark.read.parquet(f"{root}/{x}").count() for x in ("cuboid", "silver"))

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cuboid_cells": cells, "silver_rows": rows}))
    spark.stop()


if __name__ == "__main__":
    main()

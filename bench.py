"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from checks.queries import QUERIES
from searchloom.session import local_session
from searchloom.sources import driver_tables

HEADLINE = [
    "route_outcome", "contract_rows", "row_to_doc", "historical_load", "upsert_docs", "reconcile", "sample_compare", "stable_prefix",
    "incremental_run", "dlq_dedup", "commit_points", "extract_route", "file_backfill", "inverted_index", "index_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    rows = driver_tables.shard_rows(spark, sf_dir).count()
    # start-up of the JVM is not what is measured
    QUERIES["historical_load"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 2)
    rates = {n: round(rows / times[n]) for n in ("row_to_doc", "historical_load", "upsert_docs", "reconcile", "index_stream") if n in times}
    line = {
        "metric": "headline_queries_total", "value": round(sum(times.values()), 2), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "source_rows": rows, "rows_per_sec": rates,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark the headline queries.

Runs each headline key on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints one JSON line.  Every query is fully
executed with the ``noop`` sink (all rows produced, nothing collected).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "ppc_mart", "sales_divisors", "ads_summary", "weekly_rank", "inventory_change", "spend_alert",
    "available_items", "contains_join", "even_allocation", "latest_per_key", "rolling_stats",
    "monthly_sums", "dedup_any", "trends_long", "contains_documents", "replace_from_date", "ingest_two_regions",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = sys.argv[1:] or list(HEADLINE)

    from adlake.session import get_spark
    from adlake.plans.catalog import queries

    spark = get_spark(f"local[{cpus}]", app="adlake-bench", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                             "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    qs = queries()
    # warm-up: JVM, parquet footers, code paths
    qs["monthly_sums"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for k in keys:
        t0 = time.perf_counter()
        qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()  # writes of the sink keys happen while building
        times[k] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()

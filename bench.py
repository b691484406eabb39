"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the local cores. Batch
queries are written to the no-op sink: one warm-up, then the median of
``BENCH_RUNS`` runs. Streaming queries write real tables and run once.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tellerline.registry import QUERIES
from tellerline.session import build_session

BATCH = (
    "gold_daily_by_bank",
    "gold_daily_by_bank_default_window",
    "gold_daily_by_atm",
    "gold_monthly_by_customer",
    "gold_daily_upsert",
    "gold_monthly_upsert",
    "silver_visits_insert_only",
    "silver_locations_type1",
    "silver_customers_type2",
    "silver_customers_staged_updates",
    "dedupe_latest_visits",
    "visits_with_bank",
)
STREAMING = (
    "stream_stage_to_bronze",
    "stream_silver_visits",
    "stream_silver_locations",
    "stream_silver_customers",
    "stream_end_to_end_daily",
)


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in BATCH:
        timed(QUERIES[name], spark, sf_dir)
        seconds[name] = round(statistics.median(timed(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
    for name in STREAMING:
        seconds[name] = round(timed(QUERIES[name], spark, sf_dir), 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries; print one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the number of threads. Each
query is planned and run to the end (``noop`` sink), its stored intermediate
tables included: one warm-up round over all, then the median of ``BENCH_RUNS``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from shelfcast.session import clean
from shelfcast.testkit.queries import run

HEADLINE = (
    "model_train",
    "enrich_sales",
    "model_base",
    "weather_daily",
    "fact_sales",
    "rolling_means",
    "holidays_daily",
    "forecast_error",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfcast-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        run(name, spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        timed(name)
    for name in HEADLINE:
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr)
    clean(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

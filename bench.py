"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
``prepare_*`` is the one-off ordering of the ticks into blocks that every later query reads.
Each query is executed in full into a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from tickloom.plans.registry import QUERIES
    from tickloom.plans.ticks import tick_series

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("tickloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{SF_DIR}/events.parquet").count()  # JVM and reader start-up

    times: dict[str, float] = {}

    def clock(name: str, work) -> None:
        began = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - began, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    for kind in ("dense", "wide"):
        clock(f"prepare_{kind}", lambda kind=kind: tick_series(spark, SF_DIR, kind))
    for name, query in QUERIES.items():
        clock(name, lambda: query(spark, SF_DIR).write.format("noop").mode("overwrite").save())

    ticks = tick_series(spark, SF_DIR).rows.count()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "ticks": ticks,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

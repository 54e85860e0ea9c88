"""Time every registered query and print one JSON line.

BENCH_SF_DIR   folder with the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local executor threads (default 8)
BENCH_QUERIES  comma-separated subset of query names (default: all)
"""

from __future__ import annotations

import json
import os
import sys
import time

from seatledger.plans.registry import all_queries
from seatledger.session import build_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    queries = all_queries()
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(queries)

    spark = build_session(
        f"local[{cpus}]", cpus,
        {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    # Start the JVM's code paths and one Python worker before the clock.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    spark.range(8).mapInArrow(lambda batches: batches, "id bigint").collect()

    timings: dict[str, float] = {}
    for name in wanted:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {timings[name]}", file=sys.stderr)

    print(json.dumps({
        "metric": "total time of all registered queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

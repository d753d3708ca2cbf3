"""Time the registered queries and print one JSON line.

BENCH_SF_DIR   folder of parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names (default: all)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from regional_balance.session import local_session  # noqa: E402
from workload import QUERIES  # noqa: E402


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds to build the plan and compute every row and column of a query."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(QUERIES)
    spark = local_session(cores, **{"spark.sql.shuffle.partitions": cores})
    times = {}
    for name in names:
        run(spark, name, sf_dir)  # warm: code generation and file listing
        times[name] = round(run(spark, name, sf_dir), 4)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total warm query time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

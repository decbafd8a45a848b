"""Time every registered query: one warm-up, then the median of some runs, to a no-op sink.

Environment: ``BENCH_SF_DIR``, ``BENCH_CPUS``, ``BENCH_RUNS``, ``BENCH_QUERIES`` (comma-separated).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tests.checks.queries import registered
from estatelens.session import local_session


def seconds(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    queries = registered()
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(queries)
    spark = local_session(cpus, "bench", **{"spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8"})
    spark.sparkContext.setLogLevel("OFF")
    timings = {}
    for name in names:
        seconds(queries[name], spark, folder)
        timings[name] = round(statistics.median(seconds(queries[name], spark, folder) for _ in range(runs)), 4)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

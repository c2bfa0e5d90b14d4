"""Times every registered query and prints one JSON line.

BENCH_SF_DIR: table folder; BENCH_CPUS: local cores; BENCH_RUNS: runs per query, the best counts;
BENCH_QUERIES: comma-separated names, all when unset. A query that fails is listed and the rest still timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from farelens.session import build_session, drop_staged  # noqa: E402
from farelens.workload.queries import QUERIES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = build_session(
        "farelens-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        extra={"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).groupBy("id").count().write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        times = []
        try:
            for _ in range(runs):
                start = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - start)
        except Exception as error:  # the other queries are still timed
            failed[name] = f"{type(error).__name__}: {error}"[:300]
            print(f"{name} failed: {failed[name]}", file=sys.stderr)
        else:
            seconds[name] = round(min(times), 3)
    drop_staged(spark)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale,
                **({"failed": failed} if failed else {}),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Time the queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the cores (default: all).  All queries run once to warm
up and then BENCH_REPEAT times (default 2); the best run counts.  Building the query is part of its time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from issuescope.plans.registry import QUERIES  # noqa: E402
from issuescope.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(QUERIES)
    runs: dict[str, list[float]] = {name: [] for name in names}
    for _ in range(repeat + 1):
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name].append(time.perf_counter() - start)
    seconds = {name: round(min(times[1:] or times), 3) for name, times in runs.items()}
    spark.stop()
    result = {
        "metric": "total time of the queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

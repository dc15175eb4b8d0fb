"""Time the registered queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` (comma-separated) a choice of queries, ``BENCH_RUNS`` how
often each is timed after one warm-up; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from candlemill.session import get_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

# All queries but those of the training-data operators, which have a tool of their own.
HEADLINE = sorted(QUERIES)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    conf = {
        "spark.master": f"local[{cpus}]",
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.showConsoleProgress": "false",
    }
    spark = get_session("bench", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()

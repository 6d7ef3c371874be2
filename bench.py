"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default the sf0.1 tables), ``BENCH_CPUS`` (default 8) and
``BENCH_RUNS`` (default 3, after one warm-up; the median counts) set the run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemill.registry import all_queries  # noqa: E402
from tidemill.session import build_session  # noqa: E402

HEADLINE = (
    "stg_full_refresh",
    "incremental_upsert",
    "latest_per_key",
    "events_latest",
    "dq_report",
    "ingest_batch",
    "stream_ingest_once",
    "stream_events_latest",
    "content_checksum",
    "ledger_skip_anti",
    "semester_fallback",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "tidemill-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            all_queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

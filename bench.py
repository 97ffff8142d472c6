"""Times the headline queries and prints one JSON line.

`BENCH_SF_DIR` names the tables (default sf0.1), `BENCH_CPUS` the local threads,
`BENCH_QUERIES` a comma-separated list in place of the headline queries. Each query
writes its whole result to the no-op sink; the time is the best of `BENCH_RUNS`.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from tideline.context import build_session, name_local_checkpoint_dir
from validation.queries import QUERIES

HEADLINE = [
    "record_mismatch_counts",
    "file_rollup",
    "load_plan",
    "merge_load_lines",
    "outbox_batches",
    "upsert_file_counts",
    "inventory_compare",
    "folder_window",
    "table_comparison",
    "table_comparison_final",
    "status_after_load",
    "audit_failures",
    "latest_per_key",
    "merge_load_lines_second_batch",
    "outbox_writeback",
    "quota_report",
    "failure_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    name_local_checkpoint_dir(spark)
    seconds = {}
    for name in names:
        best = None
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the folder of tables (default sf0.1), BENCH_CPUS the number of local cores.
Each query runs BENCH_RUNS times (default 3) after one warm-up; the best time counts. All rows
and columns are computed and discarded by the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tunedata.plans.catalog import all_queries  # noqa: E402
from tunedata.session import local_session  # noqa: E402

HEADLINE = (
    "eval_metrics",
    "eval_by_source",
    "reward_breakdown_documents",
    "syntax_rate_by_source",
    "python_valid",
    "python_valid_column",
    "html_valid_pages",
    "conv_to_pair_flat",
    "conv_to_pair_nested",
    "jsonl_conversations",
    "sft_rows",
    "prep_report",
    "training_sets",
    "corrupt_choice",
    "pref_filter",
    "eval_requests",
    "group_relative_reward",
    "group_relative_by_source",
    "reward_window_table",
    "reward_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    # Small tables in one file each: cut them finely enough for all cores.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
    queries = all_queries()
    best: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        best[name] = round(min(times[1:]), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of best query times",
                "value": round(sum(best.values()), 4),
                "unit": "sec",
                "queries": best,
                "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

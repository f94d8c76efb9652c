"""Time the headline queries and print one JSON line.

Each query is planned anew and run to the end into a sink that discards its rows: once to warm
up, then ``BENCH_RUNS`` times, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import acreage.plans.queries  # noqa: E402,F401
from acreage.plans.registry import QUERIES  # noqa: E402
from acreage.session import local_session  # noqa: E402

HEADLINE = [
    "investor_profile",
    "profile_json_parse",
    "scd2_merge",
    "latest_flag_merge",
    "generic_upsert",
    "change_feed_diff",
    "insert_new_only",
    "bad_records",
    "dense_surrogate_key",
    "investor_match",
    "comps_band_join",
    "comps_to_sales",
    "valid_event_selection",
    "dq_all_failures",
    "conform_rename_cast",
    "csv_ingest",
    "incremental_ingest",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    names = list(QUERIES) if names == ["all"] else names
    spark = local_session(cpus, "bench")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, [round(t, 2) for t in taken], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name,
            }
        )
    )


if __name__ == "__main__":
    main()

"""Seconds per headline query (second run of each); prints one JSON line.

Results go to a no-op sink: every row is computed, none crosses to Python.
"""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import time

from takerlens.catalog import queries
from takerlens.session import build_session

HEADLINE = [
    "taker_bleed", "taker_stats", "tape_page_cap", "tape_fallback", "latest_snapshot", "series_activity",
    "classify_series", "screen", "screen_funnel", "link_markets", "upsert_merge", "upsert_changed",
    "dedupe_last_wins", "snapshot_skip_unchanged", "snapshot_prior_state", "pending_worklist", "ingest_two_source",
    "sweep_chunk_report", "dq_expectations", "pnl_reconciliation", "trade_explain", "stream_taker_stats",
    "json_ingest_trades",
]


def run(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="takerlens-bench-")
    spark = build_session("bench", f"local[{cpus}]", spark__ui__enabled="false", spark__driver__memory="12g",
                          spark__sql__shuffle__partitions=cpus, spark__ui__showConsoleProgress="false",
                          spark__sql__files__maxPartitionBytes="8MB", spark__checkpoint__dir=scratch)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for n in names:
        run(spark, folder, n)  # compile and warm up
        times[n] = round(run(spark, folder, n), 3)
    spark.stop()
    shutil.rmtree(scratch, ignore_errors=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR picks the data folder, BENCH_CPUS the local cores. Every query
runs whole, into Spark's noop sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from layerloom.session import build_session  # noqa: E402
from layerloom.workload import QUERIES  # noqa: E402

HEADLINE = (
    "raw_load",
    "staging_load",
    "extent_split",
    "extent_typed",
    "hashdiff",
    "latest_per_key",
    "scd2_initial",
    "scd2_merge_incremental",
    "scd2_merge_full",
    "scd2_merge_repeated_keys",
    "scd2_stats",
    "scd2_decision",
    "landing_inventory",
    "resolve_file_sets",
    "file_status_update",
    "quality_issues",
    "quality_summary",
    "text_sanitize",
    "load_volumetry",
    "run_metrics",
    "anomalies",
    "rates_upsert",
    "stream_scd2",
)

# Whole loads through files and stores; timed, but not part of the headline total, which keeps its queries.
STORED = ("full_run_incremental", "scd2_stored_history", "scd2_parted_history", "landing_scan", "quality_one_scan")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["latest_per_key"](spark, folder).write.format("noop").mode("overwrite").save()  # warm the JVM
    seconds = {}
    for name in (*HEADLINE, *STORED):
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    headline = {name: seconds[name] for name in HEADLINE}
    total = round(sum(headline.values()), 3)
    result = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": headline}
    print(json.dumps(result | {"stored": {name: seconds[name] for name in STORED}, "sf": Path(folder).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()

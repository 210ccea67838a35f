"""Times the headline queries and prints one JSON line.

Settings come from the environment: BENCH_SF_DIR (tables) and BENCH_CPUS
(threads). Each query runs BENCH_RUNS times and the best run counts. Building the plan is included; results are computed in full and
discarded, except where the query itself writes files.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from factprep.plans.queries import QUERIES
from factprep.session import build_session

HEADLINES = [
    "flagship_clean_enrich",
    "clean_contract",
    "clean_in_arrow",
    "clean_text_fact",
    "reject_counts",
    "exact_dedup",
    "bucket_dedup",
    "zone_join_both",
    "zone_lookup_map",
    "hop_features",
    "speed_native",
    "speed_arrow_udf",
    "speed_scalar_udf",
    "checksum_baseline",
    "checksum_speed",
    "checksum_arrow_udf",
    "checksum_scalar_udf",
    "staged_roundtrip",
    "output_roundtrip",
    "prepared_files",
    "heterogeneous_union",
    "nested_mixed_files",
    "streamed_two_sources",
    "file_inventory",
    "budget_prefix",
    "multiset_parity",
    "row_audit",
    "run_accounting",
    "run_summary",
    "output_parity",
    "duplicate_audit",
    "running_totals",
    "benchmark_summary",
    "resource_peaks",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
        },
    )
    seconds = {}
    for name in HEADLINES:
        taken = []
        for _ in range(runs):
            began = time.perf_counter()
            QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(min(taken), 3)
    raw_rows = {r.stage: r.row_count for r in QUERIES["run_accounting"](spark, root).collect()}["raw"]
    scale = re.search(r"sf([\d.]+)$", root)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(cpus),
                "flagship_raw_rows": raw_rows,
                "flagship_raw_rows_per_sec": round(raw_rows / seconds["flagship_clean_enrich"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_QUERIES (comma separated)
replaces the list. The given tables are single files of one row group, which one task has to read, as no
large table is; before anything is timed, each is copied into one file per core (BENCH_FILES, 0 to
read the given files themselves). The first query is run once to warm the session up; then every query is built and
run to the end, results thrown away, BENCH_RUNS times (three), and its median counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidegauge.plans import QUERIES  # noqa: E402
from tidegauge.session import clear_scratch, local_session  # noqa: E402

HEADLINE = (
    "metric_series_rate", "multi_rate", "counter_resets", "explained_resets", "metrics_1m",
    "events_1m", "collector_health", "arrival_rate", "benchmark_summary", "delta_panel",
    "overall_verdict", "iops_elapsed", "latency_elapsed", "workload_summary", "tier_comparison",
    "buffer_pool_hit_ratio", "qps_series", "row_operations", "recent_errors", "worst_p99",
    "top_digests", "file_latency", "file_classes", "slow_queries", "failed_logins",
    "connection_metrics", "saturation", "metric_alerts", "cardinality_audit", "validate_points",
    "series_rows", "norm_file_io", "norm_statement_digest", "outages",
)


def in_several_files(spark, folder: str, files: int, copy: str) -> str:
    """A copy of a folder of tables in which each table is so many files of about equal rows."""
    for table in sorted(Path(folder).glob("*.parquet")):
        spark.read.parquet(str(table)).repartition(files).write.parquet(f"{copy}/{table.name}")
    return copy


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cores, "bench", **{"spark.sql.shuffle.partitions": cores})
    runs, files = int(os.environ.get("BENCH_RUNS", "3")), int(os.environ.get("BENCH_FILES", cores))
    scale, timings = Path(folder).name.removeprefix("sf"), {}
    if files:
        folder = in_several_files(spark, folder, files, tempfile.mkdtemp(prefix="bench-tables-"))

    def run(name: str) -> float:
        begun = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    run(names[0])
    for name in names:
        timings[name] = round(median(run(name) for _ in range(runs)), 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    clear_scratch(spark)
    spark.stop()
    print(json.dumps({
        "metric": "total time of headline queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "files_per_table": files or 1,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))


if __name__ == "__main__":
    main()

from datetime import datetime, timedelta

import pytest

from tidegauge.operators import benchmark as b

T0 = datetime(2024, 1, 1)
BASE, CAND = b.RunTarget("base", "t1"), b.RunTarget("cand", "t2")
PAIRS = "metric string, baseline double, candidate double"
SUMMARY = ("metric string, run_id string, target_id string, host string, tier string, avg double, "
           "p95 double, max double, samples long")
INVENTORY = "run_id string, target_id string, duration_seconds long"
SERIES = (
    "ts timestamp, run_id string, target_id string, host string, tier string, measurement string, "
    "field string, series_key string, tags map<string,string>, value double"
)
COMPLETE = {
    "QPS": 100.0, "Query p95 ms": 10.0, "Query p99 ms": 20.0, "Read IOPS": 50.0,
    "Read latency ms": 2.0,
}


@pytest.mark.parametrize("metric,old,new,change,verdict", [
    ("QPS", 100.0, 110.0, 10.0, "IMPROVEMENT"),
    ("Read latency ms", 10.0, 8.0, -20.0, "IMPROVEMENT"),
    ("Query p99 ms", 10.0, 12.0, 20.0, "REGRESSION"),
    ("Query errors/s", 2.0, 3.0, 50.0, "REGRESSION"),
    ("Write throughput MiB/s", 100.0, 110.0, 10.0, "IMPROVEMENT"),
    ("Query errors/s", 0.0, 0.0, 0.0, "NO MATERIAL CHANGE"),
    ("Query errors/s", 0.0, 1.0, float("inf"), "REGRESSION"),
    ("QPS", 0.0, 1.0, float("inf"), "IMPROVEMENT"),
    ("QPS", 100.0, 104.96, 4.96, "NO MATERIAL CHANGE"),
    ("QPS", 100.0, 95.0, -5.0, "REGRESSION"),
    ("unlisted", 0.0, 3.0, 0.0, "INCONCLUSIVE"),
    ("unlisted", 2.0, 3.0, 50.0, "INCONCLUSIVE"),
])
def test_compare(spark, metric, old, new, change, verdict):
    row = b.compare(spark.createDataFrame([(metric, old, new)], PAIRS)).first()
    assert row["percent_change"] == pytest.approx(change)
    assert row["verdict"] == verdict


def summary(spark, old, new, samples=(100, 100)):
    rows = [(m, "base", "t1", "h", "v1", v, v, v, samples[0]) for m, v in old.items()]
    rows += [(m, "cand", "t2", "h", "v2", v, v, v, samples[1]) for m, v in new.items()]
    return spark.createDataFrame(rows, SUMMARY)


def test_panel_rounds_before_judging_and_the_report_does_not(spark):
    table = summary(spark, {"QPS": 100.0, "x": 0.0}, {"QPS": 104.96, "x": 5.0})
    panel = b.delta_panel(table, BASE, CAND).collect()
    assert [(r["metric"], r["percent_change"], r["interpretation"]) for r in panel] == [
        ("QPS", 5.0, "IMPROVEMENT")
    ]
    report = {r["metric"]: r["verdict"] for r in b.build_comparisons(table, BASE, CAND).collect()}
    assert report == {"QPS": "NO MATERIAL CHANGE", "x": "INCONCLUSIVE"}


def test_panel_takes_unknown_metrics_as_lower_is_better(spark):
    table = summary(spark, {"x": 10.0}, {"x": 5.0})
    row = b.delta_panel(table, BASE, CAND).first()
    assert (row["better_direction"], row["directional_score"]) == ("Lower", 50.0)


def verdict(spark, old, new, samples=(100, 100), durations=(600, 600)):
    sides = [("base", "t1", durations[0]), ("cand", "t2", durations[1])]
    inventory = spark.createDataFrame([s for s in sides if s[2]], INVENTORY)
    comparisons = b.build_comparisons(summary(spark, old, new, samples), BASE, CAND)
    gates = b.quality_gates(inventory, comparisons, BASE, CAND)
    row = b.overall_verdict(gates).first()
    return row["overall"], row["issues"], row["regressions"]


def test_pass(spark):
    assert verdict(spark, COMPLETE, COMPLETE) == ("PASS", "", "")


def test_regression(spark):
    worse = {**COMPLETE, "Read latency ms": 3.0, "QPS": 50.0}
    assert verdict(spark, COMPLETE, worse) == ("REGRESSION", "", "QPS, Read latency ms")


def test_uneven_samples_and_durations(spark):
    overall, issues, _ = verdict(spark, COMPLETE, COMPLETE, (100, 50), (600, 300))
    assert overall == "INCONCLUSIVE"
    assert "Run durations differ by 50.0% (limit 10.0%)." in issues
    assert ("Sample counts differ beyond the configured limit for: "
            "QPS, Query p95 ms, Query p99 ms, Read IOPS, Read latency ms.") in issues


def test_nothing_to_compare(spark):
    overall, issues, _ = verdict(spark, {"QPS": 1.0}, {"Read IOPS": 1.0}, durations=(600, 0))
    assert overall == "INCONCLUSIVE"
    for text in (
        "Both selected Run/Target pairs were not found.",
        "Run durations differ by 100.0% (limit 10.0%).",
        "No comparable benchmark summary metrics were found.",
        "Required comparison metrics are missing: QPS, Query p95 ms, Query p99 ms.",
        "No comparable file IOPS metric was found.",
        "No comparable file latency metric was found.",
    ):
        assert text in issues


def test_required_metrics_must_be_positive(spark):
    zero = {**COMPLETE, "Query p99 ms": 0.0}
    assert "Required metrics have non-positive values: Query p99 ms." in verdict(
        spark, zero, zero)[1]


def test_published_repetitions(spark):
    rows = [("Query p95 ms", 19.953, 6.310), ("Query p95 ms", 19.0, 6.9),
            ("Query p95 ms", 20.5, 6.19)]
    row = b.repetition_summary(spark.createDataFrame(rows, PAIRS)).first()
    assert (row["baseline_median"], row["candidate_median"]) == (19.953, 6.310)
    assert row["min_change_pct"] == pytest.approx(-69.8, abs=0.05)
    assert row["max_change_pct"] == pytest.approx(-63.7, abs=0.05)


def test_workload_summary(spark):
    rows = [("read", "completed", float(i)) for i in range(1, 5)]
    rows += [("write", "completed", 10.0), ("read", "dropped_late", None),
             ("read", "dropped_queue", None), ("write", "error", None)]
    log = spark.createDataFrame(rows, "kind string, outcome string, latency_ms double")
    row = b.workload_summary(log, [], 10).first()
    assert (row["scheduled"], row["completed"], row["dropped"], row["errors"]) == (8, 5, 2, 1)
    assert (row["completed_reads"], row["completed_writes"]) == (4, 1)
    assert (row["achieved_rate_ops_s"], row["completion_percent"]) == (0.5, 62.5)
    assert (row["latency_p50_ms"], row["latency_p95_ms"]) == (3.0, 8.8)


def test_workload_without_completions(spark):
    log = spark.createDataFrame(
        [("read", "error", None)], "kind string, outcome string, latency_ms double"
    )
    row = b.workload_summary(log, [], 10).first()
    assert (row["latency_p50_ms"], row["completed"], row["completion_percent"]) == (0.0, 0, 0.0)


def io_series(spark, samples):
    """(key, mode, field, second, value) samples of one run."""
    rows = [
        (T0 + timedelta(seconds=s), "base", "t1", "h", "v1", "mysql.file_io", field, key,
         {"event": key, "mode": mode}, float(value))
        for key, mode, field, s, value in samples
    ]
    return spark.createDataFrame(rows, SERIES)


def test_latency_is_weighted_and_needs_both_rates(spark):
    samples = []
    for key, ops, wait in (("a", 10, 100), ("b", 30, 60)):
        samples += [(key, "read", b.OPERATIONS, 0, 0), (key, "read", b.OPERATIONS, 10, ops),
                    (key, "read", b.WAIT, 0, 0), (key, "read", b.WAIT, 10, wait)]
    # The wait counter of c falls, so its operations must not count for latency.
    samples += [("c", "read", b.OPERATIONS, 0, 0), ("c", "read", b.OPERATIONS, 10, 1000),
                ("c", "read", b.WAIT, 0, 5), ("c", "read", b.WAIT, 10, 0)]
    series = io_series(spark, samples)
    latency = b.benchmark_samples(series, ["base"], groups=["latency"]).collect()
    assert [(r["metric"], r["value"]) for r in latency] == [("Read latency ms", 4.0)]
    iops = b.benchmark_samples(series, ["base"], groups=["iops"]).collect()
    assert [(r["metric"], r["value"]) for r in iops] == [("Read IOPS", 104.0)]


def test_misc_files_are_no_benchmark_metric(spark):
    samples = [("a", "misc", b.OPERATIONS, 0, 0), ("a", "misc", b.OPERATIONS, 10, 5)]
    assert b.benchmark_samples(io_series(spark, samples), ["base"]).count() == 0


def test_schemaless_digests_are_no_workload(spark):
    rows = []
    for schema in ("app", "", "(none)", None):
        tags = {"digest": "d"} if schema is None else {"digest": "d", "schema": schema}
        for second, value in ((0, 0.0), (10, 20.0)):
            rows.append((T0 + timedelta(seconds=second), "base", "t1", "h", "v1", b.DIGEST,
                         b.ERRORS, f"k{schema}", tags, value))
        rows.append((T0, "base", "t1", "h", "v1", b.DIGEST, "latency_p95_ms", f"k{schema}", tags,
                     1.0 if schema == "app" else 99.0))
    series = spark.createDataFrame(rows, SERIES)
    found = b.benchmark_samples(series, ["base"], groups=["query_errors", "query_tail"])
    assert {(r["metric"], r["value"]) for r in found.collect()} == {
        ("Query errors/s", 2.0), ("Query p95 ms", 1.0),
    }


def test_elapsed_counts_from_the_first_rate(spark):
    samples = [("a", "read", b.OPERATIONS, s, s * 2) for s in (0, 10, 25)]
    rows = b.iops_elapsed(io_series(spark, samples), BASE, CAND).collect()
    assert [(r["elapsed_seconds"], r["series"], r["iops"]) for r in rows] == [
        (0, "base / t1", 2.0), (15, "base / t1", 2.0),
    ]


def test_tier_comparison_ignores_other_metrics(spark):
    rows = [("base", "v1", "m", 1.0), ("base", "v1", "m", 3.0), ("base", "v1", "x", 9.0)]
    metrics = spark.createDataFrame(rows, "run_id string, tier string, metric string, value double")
    row = b.tier_comparison(metrics, "m", "base", "cand").first()
    assert (row["avg"], row["max"], row["samples"], row["p95"]) == (2.0, 3.0, 2, 2.9)

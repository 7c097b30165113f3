"""Comparison of two benchmark runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.scalars import relative_difference
from tidegauge.functions.tags import label, tag
from tidegauge.functions.text import literal
from tidegauge.functions.timing import whole_seconds
from tidegauge.operators.distribution import distribution
from tidegauge.operators.ordered import SLICE, SLICE_SECONDS
from tidegauge.operators.rates import between, multi_rate

# Measurement and field names, metric names and their better direction, limits.
STATUS = "mysql.global_status"
FILE_IO = "mysql.file_io"
DIGEST = "mysql.statement_digest"
OPERATIONS = "operations_total"
BYTES = "bytes_total"
WAIT = "wait_ms_total"
ERRORS = "errors_total"
NO_SCHEMA = ("", "(none)")

QPS = "QPS"
READ_IOPS, WRITE_IOPS = "Read IOPS", "Write IOPS"
READ_THROUGHPUT, WRITE_THROUGHPUT = "Read throughput MiB/s", "Write throughput MiB/s"
READ_LATENCY, WRITE_LATENCY = "Read latency ms", "Write latency ms"
QUERY_P95, QUERY_P99 = "Query p95 ms", "Query p99 ms"
QUERY_ERRORS = "Query errors/s"
REDO_WAITS = "Redo log waits/s"

HIGHER_IS_BETTER = (QPS, READ_IOPS, WRITE_IOPS, READ_THROUGHPUT, WRITE_THROUGHPUT)
LOWER_IS_BETTER = (
    READ_LATENCY, WRITE_LATENCY, QUERY_P95, QUERY_P99, QUERY_ERRORS, REDO_WAITS,
)
REQUIRED_METRICS = (QPS, QUERY_P95, QUERY_P99)
MATERIAL_CHANGE_PCT = 5.0
MAX_DURATION_DIFFERENCE_PCT = 10.0
MAX_SAMPLE_DIFFERENCE_PCT = 20.0

IMPROVEMENT, REGRESSION = "IMPROVEMENT", "REGRESSION"
NO_CHANGE, INCONCLUSIVE, PASS = "NO MATERIAL CHANGE", "INCONCLUSIVE", "PASS"

#: Fields each group of metrics is computed from.
METRIC_FIELDS: Mapping[str, tuple[tuple[str, str], ...]] = {
    "qps": ((STATUS, "Queries"),),
    "iops": ((FILE_IO, OPERATIONS),),
    "throughput": ((FILE_IO, BYTES),),
    "latency": ((FILE_IO, OPERATIONS), (FILE_IO, WAIT)),
    "query_errors": ((DIGEST, ERRORS),),
    "redo_waits": ((STATUS, "Innodb_log_waits"),),
    "query_tail": (),
}
SAMPLE_KEYS = ("ts", "run_id", "target_id", "host", "tier")
SUMMARY_KEYS = ("metric", "run_id", "target_id", "host", "tier")


@dataclass(frozen=True)
class RunTarget:
    """One side of a comparison."""

    run_id: str
    target_id: str

    def matches(self) -> Column:
        return (F.col("run_id") == self.run_id) & (F.col("target_id") == self.target_id)


def one_row(*frames: DataFrame) -> DataFrame:
    """Side-by-side form of frames with one row each and different columns."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])


def either(baseline: RunTarget, candidate: RunTarget) -> Column:
    return baseline.matches() | candidate.matches()


def tier_comparison(metrics: DataFrame, metric: str, baseline: str, candidate: str) -> DataFrame:
    """Raw values of one legacy metric in two runs."""
    chosen = metrics.filter((F.col("metric") == metric) & F.col("run_id").isin(baseline, candidate))
    return distribution(
        chosen, ["run_id", "tier", "metric"], "value", {"p95": 0.95},
        {"avg": "avg", "max": "max", "samples": "samples"},
    )


def file_io_rates(
    series: DataFrame, runs: Sequence[str], fields: Sequence[str], start=None, end=None,
    targets: Sequence[str] | None = None, modes: Sequence[str] = ("read", "write"),
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """One row per file series and instant, with a ``rate_<field>`` column per field.

    The rows are shuffled once, by series and slice; the fields of a series meet without a join.
    """
    rates = multi_rate(
        series, {FILE_IO: list(fields)}, runs, start, end, targets, slice_seconds,
        colocate=["run_id", "target_id", "series_key"], where=tag("mode").isin(*modes),
        dimensions={"mode": tag("mode")},
    )
    return rates.groupBy(
        "run_id", "target_id", "series_key", SLICE, "ts", "host", "tier", "mode"
    ).agg(*[
        F.max(F.when(F.col("field") == name, F.col("rate"))).alias(f"rate_{name}")
        for name in fields
    ])


def weighted_latency(paired: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Wait per operation of series that have both rates at an instant, weighted by operations."""
    ops, wait = F.col(f"rate_{OPERATIONS}"), F.col(f"rate_{WAIT}")
    return (
        paired.filter(ops.isNotNull() & wait.isNotNull())
        .groupBy(*keys)
        .agg(F.sum(ops).alias("_ops"), F.sum(wait).alias("_wait"))
        .filter(F.col("_ops") > 0)
        .withColumn("latency_ms", F.col("_wait") / F.col("_ops"))
        .drop("_ops", "_wait")
    )


def benchmark_samples(
    series: DataFrame, runs: Sequence[str], start=None, end=None,
    groups: Sequence[str] = tuple(METRIC_FIELDS), slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Samples of the chosen metric groups: ts, run, target, host, tier, metric, value.

    All counters go through one scan and one ordered pass. Rates of a series and instant then sit
    in one row, are summed per instant and mode, and leave as one row per metric.
    """
    parts = []
    fields: dict[str, list[str]] = {}
    for group in groups:
        for measurement, field in METRIC_FIELDS[group]:
            names = fields.setdefault(measurement, [])
            if field not in names:
                names.append(field)
    if fields:
        parts.append(_counter_samples(series, runs, start, end, groups, fields, slice_seconds))
    if "query_tail" in groups:
        parts.append(_tail_samples(series, runs, start, end))
    samples = parts[0]
    for part in parts[1:]:
        samples = samples.unionByName(part)
    return samples


def _counter_samples(series, runs, start, end, groups, fields, slice_seconds) -> DataFrame:
    measurement = F.col("measurement")
    rates = multi_rate(
        series, fields, runs, start, end, slice_seconds=slice_seconds,
        colocate=["run_id", "target_id", "series_key"],
        where=F.when(measurement == FILE_IO, tag("mode").isin("read", "write"))
        .when(measurement == DIGEST, ~tag("schema").isin(*NO_SCHEMA))
        .otherwise(True),
        dimensions={"mode": tag("mode")},
    )

    chosen = {
        "queries": (STATUS, "Queries"), "log_waits": (STATUS, "Innodb_log_waits"),
        "ops": (FILE_IO, OPERATIONS), "bytes": (FILE_IO, BYTES), "wait": (FILE_IO, WAIT),
        "errors": (DIGEST, ERRORS),
    }
    per_series = rates.groupBy(
        "run_id", "target_id", "series_key", SLICE, "ts", "host", "tier", "mode"
    ).agg(*[
        F.expr(
            f"max(rate) FILTER (WHERE measurement = {literal(m)} AND field = {literal(field)})"
        ).alias(name)
        for name, (m, field) in chosen.items()
    ])
    both = "FILTER (WHERE ops IS NOT NULL AND wait IS NOT NULL)"
    summed = per_series.groupBy(*SAMPLE_KEYS, "mode").agg(
        *[F.expr(f"sum({n})").alias(n) for n in ("queries", "log_waits", "ops", "bytes", "errors")],
        F.expr(f"sum(ops) {both}").alias("paired_ops"),
        F.expr(f"sum(wait) {both}").alias("paired_wait"),
    )

    def by_mode(read: str, write: str) -> str:
        return f"if(mode = 'read', {literal(read)}, {literal(write)})"

    offered = {
        "qps": (literal(QPS), "queries"),
        "iops": (by_mode(READ_IOPS, WRITE_IOPS), "ops"),
        "throughput": (by_mode(READ_THROUGHPUT, WRITE_THROUGHPUT), "bytes / 1024D / 1024D"),
        "latency": (
            by_mode(READ_LATENCY, WRITE_LATENCY),
            "CASE WHEN paired_ops > 0 THEN paired_wait / paired_ops END",
        ),
        "query_errors": (literal(QUERY_ERRORS), "errors"),
        "redo_waits": (literal(REDO_WAITS), "log_waits"),
    }
    rows = ", ".join(
        f"named_struct('metric', {metric}, 'value', {value})"
        for group, (metric, value) in offered.items()
        if group in groups
    )
    return summed.selectExpr(*SAMPLE_KEYS, f"inline(array({rows}))").filter("value IS NOT NULL")


def _tail_samples(series, runs, start, end) -> DataFrame:
    field = F.col("field")
    return (
        series.filter(
            between(start, end)
            & F.col("run_id").isin(*runs)
            & (F.col("measurement") == DIGEST)
            & field.isin("latency_p95_ms", "latency_p99_ms")
            & ~tag("schema").isin(*NO_SCHEMA)
        )
        .groupBy(*SAMPLE_KEYS, "field")
        .agg(F.max("value").alias("value"))
        .select(
            *SAMPLE_KEYS,
            F.when(field == "latency_p95_ms", QUERY_P95).otherwise(QUERY_P99).alias("metric"),
            "value",
        )
    )


def benchmark_summary(
    series: DataFrame, baseline_run: str, candidate_run: str, start=None, end=None,
    pairs: tuple[RunTarget, RunTarget] | None = None, slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """avg, p95, max and sample count of every benchmark metric, run and target."""
    if pairs:
        series = series.filter(either(*pairs))
    samples = benchmark_samples(
        series, [baseline_run, candidate_run], start, end, slice_seconds=slice_seconds
    )
    summary = distribution(
        samples, SUMMARY_KEYS, "value", {"p95": 0.95},
        {"avg": "avg", "max": "max", "samples": "samples"},
    )
    return summary.select(
        *SUMMARY_KEYS, *[F.round(c, 3).alias(c) for c in ("avg", "p95", "max")], "samples"
    )


def headline(series: DataFrame, baseline: RunTarget, candidate: RunTarget, start=None, end=None):
    return benchmark_summary(
        series, baseline.run_id, candidate.run_id, start, end, (baseline, candidate)
    ).orderBy("metric", "run_id")


def delta_panel(summary: DataFrame, baseline: RunTarget, candidate: RunTarget) -> DataFrame:
    """Change of p95 as the dashboard words it.

    Rounds the change before judging it, leaves out zero baselines and takes unknown metrics as
    lower-is-better. The report (``compare``) does none of these.
    """
    change = F.round(
        100.0 * (F.col("candidate") - F.col("baseline")) / F.col("baseline"), 1
    )
    return (
        summary.filter(either(baseline, candidate))
        .groupBy("metric")
        .agg(
            F.avg(F.when(F.col("run_id") == baseline.run_id, F.col("p95"))).alias("baseline"),
            F.avg(F.when(F.col("run_id") == candidate.run_id, F.col("p95"))).alias("candidate"),
        )
        .filter(F.col("baseline").isNotNull() & F.col("candidate").isNotNull())
        .filter(F.col("baseline") > 0)
        .withColumn("percent_change", change)
        .withColumn(
            "better_direction",
            F.when(F.col("metric").isin(*HIGHER_IS_BETTER), "Higher").otherwise("Lower"),
        )
        .withColumn(
            "directional_score",
            F.when(F.col("better_direction") == "Higher", F.col("percent_change"))
            .otherwise(-F.col("percent_change")),
        )
        .withColumn(
            "interpretation",
            F.when(F.col("directional_score") >= MATERIAL_CHANGE_PCT, IMPROVEMENT)
            .when(F.col("directional_score") <= -MATERIAL_CHANGE_PCT, REGRESSION)
            .otherwise(NO_CHANGE),
        )
        .orderBy("directional_score")
    )


def _elapsed(samples: DataFrame, value: str, *series_parts: str) -> DataFrame:
    # The start reads the value too (rates are never negative), so that both users of `samples`
    # need the same columns and Spark computes them once. There are two starts at most.
    starts = samples.groupBy("run_id", "target_id").agg(
        F.min(F.when(F.col(value) >= 0, F.col("ts"))).alias("run_start")
    )
    return (
        samples.join(starts, ["run_id", "target_id"])
        .select(
            whole_seconds(F.col("ts"), F.col("run_start")).alias("elapsed_seconds"),
            label(*[F.col(p) for p in series_parts]).alias("series"),
            value,
        )
        .orderBy("elapsed_seconds")
    )


def iops_elapsed(
    series: DataFrame, baseline: RunTarget, candidate: RunTarget, start=None, end=None
) -> DataFrame:
    """Read operations per second by seconds since the first rate of the run and target."""
    rates = file_io_rates(
        series.filter(either(baseline, candidate)), [baseline.run_id, candidate.run_id],
        [OPERATIONS], start, end, modes=["read"],
    )
    samples = rates.groupBy("ts", "run_id", "target_id").agg(
        F.sum(f"rate_{OPERATIONS}").alias("iops")
    )
    return _elapsed(samples, "iops", "run_id", "target_id")


def latency_elapsed(
    series: DataFrame, baseline: RunTarget, candidate: RunTarget, start=None, end=None
) -> DataFrame:
    """File latency by elapsed seconds and mode."""
    paired = file_io_rates(
        series.filter(either(baseline, candidate)), [baseline.run_id, candidate.run_id],
        [OPERATIONS, WAIT], start, end,
    )
    samples = weighted_latency(paired, ["ts", "run_id", "target_id", "mode"])
    return _elapsed(samples, "latency_ms", "run_id", "target_id", "mode")


def run_inventory(
    points: DataFrame, baseline: RunTarget, candidate: RunTarget
) -> DataFrame:
    """Extent and size of the two runs, duration in minutes."""
    duration = whole_seconds(F.col("ended"), F.col("started")) / 60.0
    return (
        points.filter(either(baseline, candidate))
        .groupBy("run_id", "target_id", "tier", "host")
        .agg(
            F.min("ts").alias("started"),
            F.max("ts").alias("ended"),
            F.count(F.lit(1)).alias("points"),
            F.count_distinct("measurement").alias("measurements"),
        )
        .withColumn("duration_minutes", F.round(duration, 1))
        .orderBy(F.desc("started"))
    )


def report_inventory(
    points: DataFrame, baseline: RunTarget, candidate: RunTarget, start, end
) -> DataFrame:
    """Extent and size of the two runs inside the report window, duration in seconds."""
    return (
        points.filter(between(start, end) & either(baseline, candidate))
        .groupBy("run_id", "target_id", "host", "tier")
        .agg(
            F.min("ts").alias("start"),
            F.max("ts").alias("end"),
            F.count(F.lit(1)).alias("points"),
            F.count_distinct("measurement").alias("measurements"),
        )
        .withColumn("duration_seconds", whole_seconds(F.col("end"), F.col("start")))
        .orderBy("run_id", "target_id")
    )


def compare(pairs: DataFrame, material_change_pct: float = MATERIAL_CHANGE_PCT) -> DataFrame:
    """Judge metric, baseline and candidate by the better direction of the metric.

    A zero baseline has no relative change: equal values are no change, any rise counts in full.
    """
    higher = F.col("metric").isin(*HIGHER_IS_BETTER)
    lower = F.col("metric").isin(*LOWER_IS_BETTER)
    known = higher | lower
    old, new = F.col("baseline"), F.col("candidate")
    change = (
        F.when((old == 0) & known & (new != 0), F.lit(float("inf")))
        .when(old == 0, F.lit(0.0))
        .otherwise(100.0 * (new - old) / old)
    )
    score = F.when(higher, F.col("percent_change")).otherwise(-F.col("percent_change"))
    return pairs.withColumn("percent_change", change).withColumn(
        "verdict",
        F.when(~known, INCONCLUSIVE)
        .when(score >= material_change_pct, IMPROVEMENT)
        .when(score <= -material_change_pct, REGRESSION)
        .otherwise(NO_CHANGE),
    )


def build_comparisons(
    summary: DataFrame, baseline: RunTarget, candidate: RunTarget,
    material_change_pct: float = MATERIAL_CHANGE_PCT,
) -> DataFrame:
    """Verdict and sample-count difference of every metric both sides have."""
    first, second = baseline.matches(), candidate.matches()
    paired = (
        summary.filter(first | second)
        .groupBy("metric")
        .agg(
            F.max(F.when(first, F.col("p95"))).alias("baseline"),
            F.max(F.when(second, F.col("p95"))).alias("candidate"),
            F.max(F.when(first, F.col("samples"))).alias("baseline_samples"),
            F.max(F.when(second, F.col("samples"))).alias("candidate_samples"),
        )
        .filter(F.col("baseline_samples").isNotNull() & F.col("candidate_samples").isNotNull())
    )
    return (
        compare(paired, material_change_pct)
        .withColumn(
            "sample_difference_pct",
            relative_difference(
                F.col("baseline_samples").cast("double"), F.col("candidate_samples").cast("double")
            ),
        )
        .select(
            "metric", "baseline", "candidate", "percent_change", "verdict",
            "sample_difference_pct",
        )
    )


def quality_gates(
    inventory: DataFrame, comparisons: DataFrame, baseline: RunTarget, candidate: RunTarget,
    max_duration_difference_pct: float = MAX_DURATION_DIFFERENCE_PCT,
    max_sample_difference_pct: float = MAX_SAMPLE_DIFFERENCE_PCT,
) -> DataFrame:
    """One row: the reasons why the two runs cannot be compared, and the regressed metrics.

    Both inputs hold one row per side or metric (eleven metrics exist), so the lists are bounded.
    """
    extent = inventory.agg(
        F.count(F.lit(1)).alias("sides"),
        F.coalesce(
            F.max(F.when(baseline.matches(), F.col("duration_seconds"))), F.lit(0)
        ).alias("old_seconds"),
        F.coalesce(
            F.max(F.when(candidate.matches(), F.col("duration_seconds"))), F.lit(0)
        ).alias("new_seconds"),
    )
    metric = F.col("metric")

    def names(condition: Column) -> Column:
        return F.array_sort(F.collect_set(F.when(condition, metric)))

    non_positive = metric.isin(*REQUIRED_METRICS) & (
        (F.col("baseline") <= 0) | (F.col("candidate") <= 0)
    )
    metrics = comparisons.agg(
        F.array_sort(F.collect_set(metric)).alias("metrics"),
        names(F.col("sample_difference_pct") > max_sample_difference_pct).alias("uneven"),
        names(non_positive).alias("non_positive"),
        names(F.col("verdict") == REGRESSION).alias("regressions"),
    )
    difference = relative_difference(
        F.col("old_seconds").cast("double"), F.col("new_seconds").cast("double")
    )
    missing = F.array_sort(
        F.array_except(F.array(*[F.lit(m) for m in REQUIRED_METRICS]), F.col("metrics"))
    )

    def listed(text: str, items: Column) -> Column:
        return F.when(
            F.size(items) > 0, F.concat(F.lit(text), F.array_join(items, ", "), F.lit("."))
        )

    def none_of(text: str, *wanted: str) -> Column:
        found = F.arrays_overlap(F.col("metrics"), F.array(*[F.lit(m) for m in wanted]))
        return F.when(~found, F.lit(text))

    # The texts of the gates, as reports show them.
    issues = F.array(
        F.when(F.col("sides") != 2, "Both selected Run/Target pairs were not found."),
        F.when(
            difference > max_duration_difference_pct,
            F.format_string(
                f"Run durations differ by %.1f%% (limit {max_duration_difference_pct:.1f}%%).",
                difference,
            ),
        ),
        listed("Sample counts differ beyond the configured limit for: ", F.col("uneven")),
        F.when(
            F.size("metrics") == 0, "No comparable benchmark summary metrics were found."
        ),
        listed("Required comparison metrics are missing: ", missing),
        listed("Required metrics have non-positive values: ", F.col("non_positive")),
        none_of("No comparable file IOPS metric was found.", READ_IOPS, WRITE_IOPS),
        none_of("No comparable file latency metric was found.", READ_LATENCY, WRITE_LATENCY),
    )
    return one_row(extent, metrics).select(F.array_compact(issues).alias("issues"), "regressions")


def overall_verdict(gates: DataFrame) -> DataFrame:
    return gates.select(
        F.when(F.size("issues") > 0, INCONCLUSIVE)
        .when(F.size("regressions") > 0, REGRESSION)
        .otherwise(PASS)
        .alias("overall"),
        F.array_join("issues", " ").alias("issues"),
        F.array_join("regressions", ", ").alias("regressions"),
    )


def repetition_summary(repetitions: DataFrame) -> DataFrame:
    """Median per side and range of the change over repetitions of (metric, baseline, candidate)."""
    change = 100.0 * (F.col("candidate") - F.col("baseline")) / F.col("baseline")
    spread = repetitions.groupBy("metric").agg(
        F.min(F.when(F.col("baseline") != 0, change)).alias("min_change_pct"),
        F.max(F.when(F.col("baseline") != 0, change)).alias("max_change_pct"),
    )
    old = distribution(repetitions, ["metric"], "baseline", {"baseline_median": 0.5}, {})
    new = distribution(repetitions, ["metric"], "candidate", {"candidate_median": 0.5}, {})
    return old.join(new, "metric").join(spread, "metric")


def workload_summary(oplog: DataFrame, keys: Sequence[str], seconds: int) -> DataFrame:
    """Counts, rate and latency percentiles of an operation log (kind, outcome, latency_ms)."""
    done = F.col("outcome") == "completed"

    def count(condition: Column) -> Column:
        return F.count(F.when(condition, F.lit(1)))

    counts = oplog.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("scheduled"),
        count(done).alias("completed"),
        count(done & (F.col("kind") == "read")).alias("completed_reads"),
        count(done & (F.col("kind") != "read")).alias("completed_writes"),
        count(F.col("outcome") == "dropped_queue").alias("dropped_queue"),
        count(F.col("outcome") == "dropped_late").alias("dropped_late"),
        count(F.col("outcome") == "error").alias("errors"),
    )
    latency = distribution(
        oplog.filter(done), keys, "latency_ms",
        {"latency_p50_ms": 0.50, "latency_p95_ms": 0.95, "latency_p99_ms": 0.99}, {},
    )
    joined = counts.join(latency, list(keys), "left") if keys else one_row(counts, latency)
    tail = ("latency_p50_ms", "latency_p95_ms", "latency_p99_ms")
    return (
        joined.withColumn("dropped", F.col("dropped_queue") + F.col("dropped_late"))
        .withColumn("achieved_rate_ops_s", F.round(F.col("completed") / F.lit(seconds), 3))
        .withColumn(
            "completion_percent",
            F.round(
                100.0 * F.col("completed") / F.greatest(F.lit(1), F.col("scheduled")), 3
            ),
        )
        .withColumns({c: F.round(F.coalesce(F.col(c), F.lit(0.0)), 3) for c in tail})
    )

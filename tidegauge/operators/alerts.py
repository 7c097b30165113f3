"""Static-threshold alerts over platform metrics, and the error-log alert."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.timing import bin_start
from tidegauge.operators.ordered import latest_before, with_previous


@dataclass(frozen=True)
class AlertRule:
    """Fires when the aggregate of a sliding window exceeds the threshold."""

    name: str
    metric: str
    aggregation: str
    threshold: float
    severity: int
    window_minutes: int
    every_minutes: int


# The alert rules and their thresholds.
RULES = (
    AlertRule("mysql-cpu-high", "cpu_percent", "Average", 85, 2, 15, 5),
    AlertRule("mysql-memory-high", "memory_percent", "Average", 90, 2, 15, 5),
    AlertRule("mysql-storage-high", "storage_percent", "Average", 85, 1, 15, 15),
    AlertRule("mysql-aborted-connections", "aborted_connections", "Total", 10, 2, 5, 5),
)
REPLICATION_RULE = AlertRule("mysql-replication-lag", "replication_lag", "Maximum", 60, 1, 15, 5)
ERROR_LEVEL = "Error"

DAY_SECONDS = 86400
#: Width of a pane. Every window and step of the rules is a whole number of panes.
PANE_SECONDS = 300
PANE_KEYS = ("metric_name", "resource", "pane")
WINDOW_KEYS = ("rule", "severity", "resource", "window_start", "window_end")


def panes(metrics: DataFrame, rules: Sequence[AlertRule] = RULES) -> DataFrame:
    """Mergeable sums per metric, resource and pane.

    Overlapping windows share panes, so raw rows are aggregated once, not once per window.
    """
    return (
        metrics.filter(F.col("metric_name").isin(*sorted({r.metric for r in rules})))
        .groupBy("metric_name", "resource", bin_start(F.col("time_generated"), PANE_SECONDS).alias("pane"))
        .agg(
            F.sum("average").alias("sum_average"),
            F.count("average").alias("count_average"),
            F.sum("total").alias("sum_total"),
            F.max("maximum").alias("max_maximum"),
        )
    )


def _windows(rule: AlertRule) -> Column:
    """Starts of all windows of the rule that contain the pane."""
    size, step = rule.window_minutes * 60, rule.every_minutes * 60
    last = F.unix_seconds("pane") - F.pmod(F.unix_seconds("pane"), F.lit(step))
    starts = F.array(*[last - F.lit(i * step) for i in range(size // step)])
    return F.filter(starts, lambda s: s + F.lit(size) > F.unix_seconds("pane"))


def windows_of(pane_rows: DataFrame, rules: Sequence[AlertRule] = RULES) -> DataFrame:
    """The panes, once for each rule and window they belong to."""
    described = F.array(*[
        F.struct(
            F.lit(r.metric).alias("metric"), F.lit(r.name).alias("rule"),
            F.lit(r.aggregation).alias("aggregation"),
            F.lit(float(r.threshold)).alias("threshold"),
            F.lit(r.severity).alias("severity"), F.lit(r.window_minutes * 60).alias("size"),
            _windows(r).alias("starts"),
        )
        for r in rules
    ])
    return (
        pane_rows.select("*", F.inline(described))
        .filter(F.col("metric") == F.col("metric_name"))
        .select("*", F.explode("starts").alias("start"))
        .withColumn("window_start", F.timestamp_seconds("start"))
        .withColumn("window_end", F.timestamp_seconds(F.col("start") + F.col("size")))
    )


def judged(windows: DataFrame) -> DataFrame:
    """Value and threshold of every window, whether it fires or not."""
    value = (
        F.when(F.col("aggregation") == "Average", F.sum("sum_average") / F.sum("count_average"))
        .when(F.col("aggregation") == "Total", F.sum("sum_total"))
        .otherwise(F.max("max_maximum"))
    )
    return (
        windows.groupBy(*WINDOW_KEYS, "aggregation", "threshold")
        .agg(value.alias("value"))
        .select(*WINDOW_KEYS, "value", "threshold")
    )


def evaluate(pane_rows: DataFrame, rules: Sequence[AlertRule] = RULES) -> DataFrame:
    """Windows whose value exceeds the threshold of their rule."""
    return judged(windows_of(pane_rows, rules)).filter("value > threshold")


def metric_alerts(metrics: DataFrame, rules: Sequence[AlertRule] = RULES) -> DataFrame:
    return evaluate(panes(metrics, rules), rules)


def alert_history(fired: DataFrame, rules: Sequence[AlertRule] = RULES) -> DataFrame:
    """When each alert fired and when it resolved: a row per rule, resource and run of firing windows.

    ``fired`` are windows above their threshold (``evaluate``, ``current_alerts``). An alert fires at
    the end of its first window and resolves at the next evaluation that does not fire, whether it is
    below the threshold or has no data. Runs are found by the window before and the first window of the
    run, both through time slices, so a rule that fires for ever stays spread out.
    """
    keys = ["rule", "severity", "resource"]
    step = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.every_minutes * 60)])[F.col("rule")]
    seconds = F.unix_seconds("window_start")
    rows = fired.select(*keys, "window_start", "window_end", step.alias("step"), "value", "threshold")
    # The window before by its start; the one behind by the same, with time running backwards.
    forward = with_previous(rows, keys, "window_start", "value", slice_seconds=DAY_SECONDS)
    opens = F.coalesce(F.unix_seconds("prev_ts") < seconds - F.col("step"), F.lit(True))
    back = forward.withColumn("opens", opens).select(
        *keys, "window_start", "window_end", "step", "value", "threshold", "opens",
        F.timestamp_seconds(-seconds).alias("reverse"),
    )
    behind = with_previous(back, keys, "reverse", "value", slice_seconds=DAY_SECONDS).withColumn(
        "closes", F.coalesce(F.unix_seconds("prev_ts") < F.unix_seconds("reverse") - F.col("step"), F.lit(True))
    )
    marks = behind.filter("opens").select(*keys, "window_start", F.col("window_end").alias("fired_at"))
    ends = behind.filter("closes").select(
        *keys, "window_start", (F.col("window_end") + F.make_interval(secs=F.col("step"))).alias("resolved_at"), "step")
    matched = latest_before(
        ends, marks, keys, payload=["fired_at"], ts="window_start", slice_seconds=DAY_SECONDS)
    first = F.unix_seconds("mark_ts")
    return matched.select(
        *keys, "fired_at", "resolved_at",
        ((seconds - first) / F.col("step") + 1).cast("long").alias("windows"),
    )


def replication_lag_alert(metrics: DataFrame) -> DataFrame:
    """Opt-in: without a replica the metric never reports."""
    return metric_alerts(metrics, [REPLICATION_RULE])


def error_alert(events: DataFrame) -> DataFrame:
    return events.filter(F.col("level") == ERROR_LEVEL).select(
        "ts", "run_id", "host", "error_code", "subsystem", "message"
    )

"""Collector liveness and data arrival.

``as_of`` stands for the current time everywhere, so results can be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.tags import label
from tidegauge.functions.timing import bin_start, whole_seconds
from tidegauge.operators.rates import between

#: Names of the heartbeat, the dead line and the probe left out of panels.
HEALTH = "collector.health"
HEARTBEAT = "heartbeat"
CYCLE_DURATION = "cycle_duration_ms"
LEGACY_HEARTBEAT = "collector_heartbeat"
DOWN_AFTER_SECONDS = 60
PROBE = "verify-probe"


def _now(as_of: datetime) -> Column:
    return F.lit(as_of).cast("timestamp")


def selected(runs: Sequence[str] | None, targets: Sequence[str] | None = None) -> Column:
    condition = F.lit(True)
    if runs is not None:
        condition = condition & F.col("run_id").isin(*runs)
    if targets is not None:
        condition = condition & F.col("target_id").isin(*targets)
    return condition


def collector_health(
    series: DataFrame, metrics: DataFrame, as_of: datetime, lookback: timedelta = timedelta(minutes=15)
) -> DataFrame:
    """Seconds since the last heartbeat per target, host and run.

    Legacy beats count only for a host and run without any series beat. Both sides shrink to one
    row per key before they meet.
    """
    recent = F.col("ts") > F.lit(as_of - lookback).cast("timestamp")
    current = (
        series.filter(recent & (F.col("measurement") == HEALTH) & (F.col("field") == HEARTBEAT))
        .groupBy("target_id", "host", "run_id")
        .agg(F.max("ts").alias("last_beat"))
    )
    legacy = (
        metrics.filter(recent & (F.col("metric") == LEGACY_HEARTBEAT))
        .groupBy("host", "run_id")
        .agg(F.max("ts").alias("last_beat"))
        .join(current.select("host", "run_id"), ["host", "run_id"], "left_anti")
        .select(F.col("host").alias("target_id"), "host", "run_id", "last_beat")
    )
    age = whole_seconds(_now(as_of), F.col("last_beat"))
    return current.unionByName(legacy).select(
        "target_id", "host", "run_id", "last_beat",
        age.alias("seconds_since_last_beat"),
        F.when(age > DOWN_AFTER_SECONDS, "DOWN").otherwise("OK").alias("status"),
    )


def heartbeat_alert(metrics: DataFrame, as_of: datetime) -> DataFrame:
    """Hosts that beat in the last five minutes, but not in the last minute."""
    return (
        metrics.filter(
            (F.col("metric") == LEGACY_HEARTBEAT)
            & (F.col("ts") > F.lit(as_of - timedelta(minutes=5)).cast("timestamp"))
        )
        .groupBy("host")
        .agg(F.max("ts").alias("last_seen"))
        .filter(
            F.col("last_seen")
            < F.lit(as_of - timedelta(seconds=DOWN_AFTER_SECONDS)).cast("timestamp")
        )
    )


def heartbeat_panel(
    series: DataFrame, metrics: DataFrame, runs: Sequence[str], as_of: datetime,
    lookback: timedelta = timedelta(days=90),
) -> DataFrame:
    return (
        collector_health(series, metrics, as_of, lookback)
        .filter(selected(runs) & (F.col("target_id") != PROBE))
        .orderBy(F.desc("seconds_since_last_beat"))
    )


def distinct_fields(series: DataFrame, runs: Sequence[str], start=None, end=None) -> DataFrame:
    return (
        series.filter(between(start, end) & selected(runs) & (F.col("target_id") != PROBE))
        .groupBy("target_id", "measurement")
        .agg(F.count_distinct("field").alias("fields"))
        .orderBy("target_id", "measurement")
    )


def rows_ingested(points: DataFrame, runs: Sequence[str], start=None, end=None) -> DataFrame:
    return (
        points.filter(between(start, end) & selected(runs) & (F.col("target_id") != PROBE))
        .groupBy("target_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def arrival_rate(
    points: DataFrame, runs: Sequence[str], start=None, end=None, seconds: int = 60
) -> DataFrame:
    return (
        points.filter(between(start, end) & selected(runs) & (F.col("target_id") != PROBE))
        .groupBy(bin_start(F.col("ts"), seconds).alias("ts"), "target_id", "measurement")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("ts", label(F.col("target_id"), F.col("measurement")).alias("series"), "rows")
        .orderBy("ts")
    )


def cycle_duration(series: DataFrame, runs: Sequence[str], start=None, end=None) -> DataFrame:
    return (
        series.filter(
            between(start, end)
            & (F.col("measurement") == HEALTH)
            & (F.col("field") == CYCLE_DURATION)
            & selected(runs)
        )
        .select("ts", "target_id", "value")
        .orderBy("ts")
    )


def ingestion_lag(points: DataFrame, as_of: datetime) -> DataFrame:
    """Newest sample, size and age of every run and target."""
    return (
        points.filter((F.col("run_id") != PROBE) & (F.col("target_id") != PROBE))
        .groupBy("run_id", "target_id", "host", "tier")
        .agg(
            F.max("ts").alias("newest"),
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct("measurement").alias("measurements"),
        )
        .withColumn("age_seconds", whole_seconds(_now(as_of), F.col("newest")))
        .orderBy(F.desc("newest"))
    )

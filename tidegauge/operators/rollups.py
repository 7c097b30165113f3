"""One-minute rollups of legacy metrics and events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.timing import bin_start

ROLLUP_SECONDS = 60
METRIC_KEYS = ("run_id", "host", "tier", "metric")
EVENT_KEYS = ("run_id", "host", "tier", "level", "subsystem")


def metrics_rollup(metrics: DataFrame, seconds: int = ROLLUP_SECONDS) -> DataFrame:
    """avg, max, min and count per time bin and metric."""
    return metrics.groupBy(bin_start(F.col("ts"), seconds).alias("ts"), *METRIC_KEYS).agg(
        F.avg("value").alias("avg"),
        F.max("value").alias("max"),
        F.min("value").alias("min"),
        F.count(F.lit(1)).alias("samples"),
    )


def metrics_partials(metrics: DataFrame, seconds: int = ROLLUP_SECONDS) -> DataFrame:
    """Mergeable form of the metric rollup: sum and value count instead of the average."""
    return metrics.groupBy(bin_start(F.col("ts"), seconds).alias("ts"), *METRIC_KEYS).agg(
        F.sum("value").alias("total"),
        F.count("value").alias("valued"),
        F.max("value").alias("max"),
        F.min("value").alias("min"),
        F.count(F.lit(1)).alias("samples"),
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """Metric rollup of partial rows from any number of batches, late ones included."""
    return partials.groupBy("ts", *METRIC_KEYS).agg(
        (F.sum("total") / F.sum("valued")).alias("avg"),
        F.max("max").alias("max"),
        F.min("min").alias("min"),
        F.sum("samples").alias("samples"),
    )


def events_rollup(events: DataFrame, seconds: int = ROLLUP_SECONDS) -> DataFrame:
    """Event count per time bin, level and subsystem, without reading messages."""
    return events.groupBy(bin_start(F.col("ts"), seconds).alias("ts"), *EVENT_KEYS).agg(
        F.count(F.lit(1)).alias("events")
    )


def backfill(metrics: DataFrame, path: str, seconds: int = ROLLUP_SECONDS) -> None:
    """Write the rollup of a populated table, replacing only the days the input holds.

    The input must hold whole days; dynamic partition overwrite leaves all other days alone.
    """
    (
        metrics_rollup(metrics, seconds)
        .withColumn("day", F.to_date("ts"))
        .repartition("day", "metric", "host")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )

"""Continuously kept rollups and alerts.

A batch only adds its own partial sums; readers merge them. A late row thus simply counts, however
late it is, and no state has to be kept between batches. Partial sums of a day are merged level by
level as batches come, so a reader meets few folders however long the stream has run.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidegauge.operators.alerts import (
    PANE_KEYS,
    RULES,
    WINDOW_KEYS,
    AlertRule,
    evaluate,
    judged,
    panes,
    windows_of,
)
from tidegauge.operators.rollups import (
    EVENT_KEYS,
    METRIC_KEYS,
    events_rollup,
    merge_partials,
    metrics_partials,
)
from tidegauge.streaming.batches import read_batch, read_batches, write_batch
from tidegauge.streaming.levels import DAY, FANOUT, add_batch, read_table


def metrics_stream(metrics: DataFrame, folder: str, fanout: int = FANOUT) -> DataStreamWriter:
    """Writer of partial sums per minute into the table ``folder``."""
    return metrics.writeStream.foreachBatch(lambda batch, batch_id: add_batch(
        metrics_partials(batch), folder, batch_id, combine=combined_metrics, fanout=fanout
    ))


def events_stream(events: DataFrame, folder: str, fanout: int = FANOUT) -> DataStreamWriter:
    """Writer of event counts per minute into the table ``folder``."""
    return events.writeStream.foreachBatch(lambda batch, batch_id: add_batch(
        events_rollup(batch), folder, batch_id, combine=combined_events, fanout=fanout
    ))


def combined_metrics(partials: DataFrame) -> DataFrame:
    """Partial sums of any batches as those of one."""
    return partials.groupBy(DAY, "ts", *METRIC_KEYS).agg(
        *[F.sum(c).alias(c) for c in ("total", "valued", "samples")],
        F.max("max").alias("max"), F.min("min").alias("min"),
    )


def combined_events(counts: DataFrame) -> DataFrame:
    return counts.groupBy(DAY, "ts", *EVENT_KEYS).agg(F.sum("events").alias("events"))


def read_metrics_rollup(spark: SparkSession, folder: str, first: date | None = None) -> DataFrame:
    """The rollup so far; days before ``first`` are not listed."""
    return merge_partials(read_table(spark, folder, first))


def read_events_rollup(spark: SparkSession, folder: str, first: date | None = None) -> DataFrame:
    return combined_events(read_table(spark, folder, first)).drop(DAY)


def windowed_metrics(metrics: DataFrame, delay: str = "3600 seconds") -> DataFrame:
    """Streaming rollup that emits a minute once, when the watermark has passed it.

    For sinks that can neither merge nor replace rows. The delay must cover the replay of spooled
    segments, because rows behind the watermark are left out here.
    """
    return (
        metrics.withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 minute").alias("w"), *METRIC_KEYS)
        .agg(
            F.avg("value").alias("avg"), F.max("value").alias("max"),
            F.min("value").alias("min"), F.count(F.lit(1)).alias("samples"),
        )
        .select(F.col("w.start").alias("ts"), *METRIC_KEYS, "avg", "max", "min", "samples")
    )


def _merged_panes(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*PANE_KEYS).agg(
        F.sum("sum_average").alias("sum_average"),
        F.sum("count_average").alias("count_average"),
        F.sum("sum_total").alias("sum_total"),
        F.max("max_maximum").alias("max_maximum"),
    )


def alert_stream(
    metrics: DataFrame, folder: str, rules: Sequence[AlertRule] = RULES
) -> DataStreamWriter:
    """Writer that keeps panes by day and, per batch, judges the windows the batch touched.

    A touched window is written whether it fires or not, so that one which falls back below its
    threshold takes back the alert of an earlier batch.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        write_batch(
            panes(batch, rules).withColumn("day", F.to_date("pane")), f"{folder}/panes", batch_id,
            by=["day"],
        )
        spark = batch.sparkSession
        own = read_batch(spark, f"{folder}/panes", batch_id)
        touched = windows_of(own, rules).select(*WINDOW_KEYS).distinct()
        # Windows are shorter than a day: the touched days and their neighbours hold all of them.
        days = [
            r["d"] for r in own.select(F.explode(F.expr(
                "array(date_sub(day, 1), day, date_add(day, 1))")).alias("d")).distinct().collect()
        ]
        near = read_batches(spark, f"{folder}/panes").filter(F.col("day").isin(days))
        found = judged(windows_of(_merged_panes(near), rules)).join(touched, [*WINDOW_KEYS], "left_semi")
        write_batch(found.withColumn("version", F.lit(batch_id)), f"{folder}/alerts", batch_id)

    return metrics.writeStream.foreachBatch(step)


def current_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The windows that fire by their latest evaluation."""
    rows = read_batches(spark, f"{folder}/alerts")
    return (
        rows.groupBy(*WINDOW_KEYS)
        .agg(F.max_by(F.struct("value", "threshold"), "version").alias("latest"))
        .select(*WINDOW_KEYS, "latest.value", "latest.threshold")
        .filter("value > threshold")
    )


def all_alerts(spark: SparkSession, folder: str, rules: Sequence[AlertRule] = RULES) -> DataFrame:
    """Alerts of everything streamed so far, from the stored panes."""
    return evaluate(_merged_panes(read_batches(spark, f"{folder}/panes")), rules)

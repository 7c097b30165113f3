"""Silence of collectors on a live heartbeat stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidegauge.operators.health import DOWN_AFTER_SECONDS, HEALTH, HEARTBEAT
from tidegauge.streaming.levels import add_batch, read_table

KEYS = ("target_id", "host", "run_id")


_BEAT = "CASE WHEN ts IS NOT NULL THEN measurement = '{}' AND field = '{}' ELSE false END".format(HEALTH, HEARTBEAT)


def clock(spark: SparkSession) -> DataFrame:
    """A stream of one tick a second, ``ts``, for ``outages``."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(
        F.col("timestamp").alias("ts"))


def outages(series: DataFrame, delay: str = "10 seconds", ticks: DataFrame | None = None) -> DataFrame:
    """One row per collector and silence: its last beat, and when it counted as down.

    Beats at most a minute apart form a session. A stream in append mode emits a session once the
    watermark has passed its end, which is the moment the collector has been silent too long.
    Sessions are merged inside each task before the shuffle, so a collector with very many beats
    travels as a few rows. ``ticks`` (``ts``) are times at which nothing needs to have happened: they
    move the watermark on when every collector is silent, and are no beats.
    """
    gap = f"{DOWN_AFTER_SECONDS} seconds 1 microsecond"
    rows = series.select("ts", *KEYS, "measurement", "field")
    if ticks is not None:
        rows = rows.unionByName(ticks.select("ts"), allowMissingColumns=True)
    # The condition names the time, so that Spark tests it behind the watermark, which ticks must reach.
    return (
        rows.withWatermark("ts", delay).filter(_BEAT)
        .groupBy(F.session_window("ts", gap).alias("w"), *KEYS)
        .agg(F.max("ts").alias("last_beat"), F.count(F.lit(1)).alias("beats"))
        .select(
            *KEYS, F.col("w.start").alias("first_beat"), "last_beat", "beats",
            (F.col("last_beat") + F.make_interval(secs=F.lit(DOWN_AFTER_SECONDS)))
            .alias("down_at"),
        )
    )


def session_stream(series: DataFrame, folder: str) -> DataStreamWriter:
    """Writer that keeps the sessions of each batch; a late beat simply counts when they are read."""
    return series.writeStream.foreachBatch(
        lambda batch, batch_id: add_batch(
            outages(batch).drop("down_at"), f"{folder}/sessions", batch_id, ts="first_beat"
        )
    )


def current_outages(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions over all batches so far, those at most a minute apart merged.

    A collector's sessions, not its beats, are ordered together.
    """
    by_start = W.partitionBy(*KEYS).orderBy("first_beat", "last_beat")
    before = F.max("last_beat").over(by_start.rowsBetween(W.unboundedPreceding, -1))
    gap = F.make_interval(secs=F.lit(DOWN_AFTER_SECONDS))
    starts = F.coalesce((F.col("first_beat") > F.col("before") + gap).cast("int"), F.lit(1))
    return (
        read_table(spark, f"{folder}/sessions")
        .withColumn("before", before)
        .withColumn("session", F.sum(starts).over(by_start))
        .groupBy(*KEYS, "session")
        .agg(F.min("first_beat").alias("first_beat"), F.max("last_beat").alias("last_beat"),
             F.sum("beats").alias("beats"))
        .select(*KEYS, "first_beat", "last_beat", "beats", (F.col("last_beat") + gap).alias("down_at"))
    )

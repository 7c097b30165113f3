"""Stored layout of the telemetry tables and their lifecycle.

Rows lie below a folder per measurement and day. Filters on both prune whole folders, which is what
every rate, panel and rollup asks for first, and an expired day is dropped without rewriting
anything.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.audits import RETENTION_DAYS, retained

DAY = "day"


def save_series(series: DataFrame, table: str) -> None:
    """Append series rows to a catalog table partitioned by measurement and day.

    Spark splits a day of a measurement by its size. Files are sorted inside, so that a field and
    series are found by the statistics of their row groups.
    """
    (
        series.withColumn(DAY, F.to_date("ts"))
        .hint("rebalance", F.col("measurement"), F.col(DAY))
        .sortWithinPartitions("measurement", DAY, "field", "series_key", "ts")
        .write.mode("append").format("parquet").partitionBy("measurement", DAY)
        .saveAsTable(table)
    )


def read_current(spark: SparkSession, table: str, as_of: datetime) -> DataFrame:
    """Rows within the lifecycle; days before it are not listed, let alone read."""
    first = (as_of - timedelta(days=RETENTION_DAYS)).date()
    return (
        spark.table(table)
        .filter((F.col(DAY) >= F.lit(first)) & retained("ts", as_of))
        .drop(DAY)
    )


def drop_expired(spark: SparkSession, table: str, as_of: datetime) -> int:
    """Drop the partitions of days wholly past their lifecycle; returns how many.

    Only partition names come to the driver: measurements times days.
    """
    first = (as_of - timedelta(days=RETENTION_DAYS)).date().isoformat()
    dropped = 0
    for row in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator():
        values = dict(part.split("=", 1) for part in row["partition"].split("/"))
        if values[DAY] < first:
            spec = ", ".join(f"{name} = '{value}'" for name, value in values.items())
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec}) PURGE")
            dropped += 1
    return dropped

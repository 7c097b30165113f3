"""The lifecycle that every stored table and rollup shares.

The tables are those that streams keep (``streaming.levels``), each in a folder of its own name.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidegauge.operators.audits import RETENTION_DAYS, retained
from tidegauge.streaming import levels

#: Raw tables and rollups; all are dropped by the same rule.
TABLES = ("points", "series", "metrics", "events", "metrics_1m", "events_1m")


def first_day(as_of: datetime, days: int = RETENTION_DAYS) -> date:
    """The first day of which anything is within the lifecycle."""
    return (as_of - timedelta(days=days)).date()


def expire_tables(spark: SparkSession, folder: str, as_of: datetime, days: int = RETENTION_DAYS) -> dict[str, int]:
    """Drop the days wholly past the lifecycle from all tables; folders dropped, by table.

    Nothing is rewritten: the days go from the tables' manifests, and later from disk by ``vacuum``.
    """
    return {name: levels.expire(spark, f"{folder}/{name}", first_day(as_of, days)) for name in TABLES}


def vacuum_tables(spark: SparkSession, folder: str, before: datetime) -> dict[str, int]:
    """Remove what the tables dropped or merged before a time; folders removed, by table."""
    return {name: levels.vacuum(spark, f"{folder}/{name}", before) for name in TABLES}


def read_current(
    spark: SparkSession, folder: str, name: str, as_of: datetime, days: int = RETENTION_DAYS,
    schema: str | None = None,
) -> DataFrame:
    """The rows of a table within the lifecycle; days before it are not listed, let alone read."""
    rows = levels.read_table(spark, f"{folder}/{name}", first_day(as_of, days), schema=schema)
    return rows.filter(retained("ts", as_of, days)).drop(levels.DAY)

"""Data-quality audits. Each returns a few counts and a pass flag per checked thing."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.benchmark import one_row
from tidegauge.operators.health import LEGACY_HEARTBEAT

# Contract version, retention, server version and series bounds per measurement.
CONTRACT_VERSION = 2
RETENTION_DAYS = 90
SERVER_VERSION = "8.4"
VERSION_VARIABLE = "version"
REDO_VARIABLE = "innodb_redo_log_capacity"
TLS_VARIABLE = "require_secure_transport"
#: Largest number of items a snapshot may hold; file IO has three modes per item.
TOP_K = {
    "mysql.file_io": 100,
    "mysql.statement_digest": 50,
    "mysql.schema_size": 500,
    "mysql.table_io": 100,
    "mysql.index_io": 100,
}
SERIES_PER_ITEM = {"mysql.file_io": 3}


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def audit_heartbeats(metrics: DataFrame, cycles: DataFrame) -> DataFrame:
    """Heartbeats against cycles (run_id, cycle_ts) of every run."""
    beats = (
        metrics.filter(F.col("metric") == LEGACY_HEARTBEAT)
        .groupBy("run_id")
        .agg(F.count(F.lit(1)).alias("heartbeats"))
    )
    return (
        cycles.groupBy("run_id")
        .agg(F.count_distinct("cycle_ts").alias("cycles"))
        .join(beats, "run_id", "left")
        .withColumn("heartbeats", F.coalesce("heartbeats", F.lit(0)))
        .withColumn("passed", F.col("heartbeats") >= F.col("cycles"))
        .select("run_id", "heartbeats", "cycles", "passed")
    )


def audit_tags(rows: DataFrame) -> DataFrame:
    """Rows without a run or a tier."""
    lacking = F.coalesce(F.col("run_id"), F.lit("")) == ""
    lacking = lacking | (F.coalesce(F.col("tier"), F.lit("")) == "")
    return rows.agg(F.count(F.lit(1)).alias("rows"), _count(lacking).alias("untagged")).withColumn(
        "passed", F.col("untagged") == 0
    )


def audit_timestamps(rows: DataFrame, ts_text: str = "ts") -> DataFrame:
    """Wire rows whose timestamp text does not end in Z."""
    naive = ~F.coalesce(F.col(ts_text).endswith("Z"), F.lit(False))
    return rows.agg(F.count(F.lit(1)).alias("rows"), _count(naive).alias("without_z")).withColumn(
        "passed", F.col("without_z") == 0
    )


def audit_sources(rows: DataFrame) -> DataFrame:
    return rows.select(F.coalesce("source", F.lit("")).alias("source")).distinct().orderBy("source")


def audit_legacy_presence(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("metric").alias("metrics"),
        F.max("ts").alias("last_ts"),
    )


def audit_contract_presence(points: DataFrame) -> DataFrame:
    """Points per run; passes when the only contract version is the current one."""
    return (
        points.groupBy("run_id")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct("measurement").alias("measurements"),
            F.count_distinct(F.nullif("target_id", F.lit(""))).alias("targets"),
            F.min("contract_version").alias("min_version"),
            F.max("contract_version").alias("max_version"),
        )
        .withColumn(
            "passed",
            (F.col("min_version") == CONTRACT_VERSION)
            & (F.col("max_version") == CONTRACT_VERSION)
            & (F.col("targets") > 0),
        )
    )


def audit_categories(diagnostics: DataFrame) -> DataFrame:
    """Diagnostic rows by category; no category may be an error log."""
    return (
        diagnostics.groupBy("category")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("passed", ~F.col("category").contains("Error"))
    )


def retained(ts: str, as_of: datetime, days: int = RETENTION_DAYS) -> Column:
    return F.col(ts) >= F.lit(as_of - timedelta(days=days)).cast("timestamp")


def retention_filter(table: DataFrame, as_of: datetime, ts: str = "ts") -> DataFrame:
    """Rows still inside the lifecycle that every table and rollup shares."""
    return table.filter(retained(ts, as_of))


def audit_retention(tables: Mapping[str, DataFrame], as_of: datetime) -> DataFrame:
    """Oldest row of every table against the lifecycle."""
    parts = [
        frame.agg(F.min("ts").alias("oldest"), _count(~retained("ts", as_of)).alias("expired"))
        .select(F.lit(name).alias("table_name"), "oldest", "expired")
        for name, frame in tables.items()
    ]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part)
    return joined.withColumn("passed", F.col("expired") == 0)


def server_compliance(variables: DataFrame) -> DataFrame:
    """Latest configuration facts per target against what the product requires.

    ``variables`` has target_id, observed_at, variable_name and variable_value.
    """

    def latest(name: str) -> Column:
        chosen = F.col("variable_name") == name
        return F.max_by(
            F.when(chosen, F.col("variable_value")),
            F.when(chosen, F.struct("observed_at", "variable_value")),
        )

    return (
        variables.filter(
            F.col("variable_name").isin(VERSION_VARIABLE, REDO_VARIABLE, TLS_VARIABLE)
        )
        .groupBy("target_id")
        .agg(
            latest(VERSION_VARIABLE).alias("version"),
            latest(REDO_VARIABLE).alias("redo_capacity"),
            latest(TLS_VARIABLE).alias("secure_transport"),
        )
        .withColumn(
            "version_ok", F.coalesce(F.col("version").startswith(SERVER_VERSION), F.lit(False))
        )
        .withColumn("redo_ok", F.col("redo_capacity").isNotNull())
        .withColumn(
            "tls_ok", F.coalesce(F.upper("secure_transport") == "ON", F.lit(False))
        )
    )


def freshness_probe(
    metrics: DataFrame, points: DataFrame, series: DataFrame, metric: str, target: str,
    since: datetime,
) -> DataFrame:
    """Whether probe rows have reached the three tables."""
    recent = (F.col("target_id") == target) & (F.col("ts") >= F.lit(since).cast("timestamp"))
    return one_row(
        metrics.filter(F.col("metric") == metric).agg(F.count(F.lit(1)).alias("legacy")),
        points.filter(recent).agg(F.count(F.lit(1)).alias("packed")),
        series.filter(recent).agg(F.count(F.lit(1)).alias("series")),
    ).withColumn(
        "visible", (F.col("legacy") > 0) & (F.col("packed") > 0) & (F.col("series") >= 1)
    )


def cardinality_audit(
    points: DataFrame, top_k: Mapping[str, int] | None = None
) -> DataFrame:
    """Largest number of series in one snapshot of each target against the bound."""
    bounds = TOP_K if top_k is None else top_k
    limit = F.coalesce(*[
        F.when(F.col("measurement") == m, F.lit(k * SERIES_PER_ITEM.get(m, 1)))
        for m, k in bounds.items()
    ])
    return (
        points.filter(F.col("measurement").isin(*bounds))
        .groupBy("target_id", "measurement", "ts")
        .agg(F.count_distinct("series_key").alias("series"))
        .groupBy("target_id", "measurement")
        .agg(F.max("series").alias("series"))
        .withColumn("bound", limit)
        .withColumn("passed", F.col("series") <= F.col("bound"))
    )

"""Queries over the platform's own metric, diagnostic and activity tables.

Platform metrics are pre-aggregated per minute, so each of their columns has its one fitting
aggregate. Metric names are case-sensitive. ``as_of`` and a lookback stand for the time filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegauge.functions.scalars import has_term
from tidegauge.functions.timing import bin_start
from tidegauge.operators.distribution import distribution

# Categories, metric lists and list sizes of the platform queries.
SLOW_LOGS = "MySqlSlowLogs"
AUDIT_LOGS = "MySqlAuditLogs"
CONNECTION_CLASS = "connection_log"
PROVIDER = "MICROSOFT.DBFORMYSQL"
CONNECTION_METRICS = (
    "active_connections", "total_connections", "aborted_connections", "Threads_running",
)
CPU_MEMORY_METRICS = (
    "cpu_percent", "memory_percent", "cpu_credits_remaining", "cpu_credits_consumed",
)
SATURATION_METRICS = (
    "cpu_percent", "memory_percent", "io_consumption_percent", "storage_percent",
)
STORAGE_METRICS = (
    "io_consumption_percent", "storage_percent", "storage_used", "storage_limit",
    "data_storage_used", "binlog_storage_used", "Innodb_data_writes",
    "Innodb_buffer_pool_reads", "Innodb_buffer_pool_read_requests",
)
RESTART_TERMS = ("restart", "failover", "start", "stop")
SLOW_ROWS, AUDIT_ROWS, ACTIVITY_ROWS, LISTED_USERS = 200, 500, 200, 10
BIN_SECONDS = 300


def since(as_of: datetime, lookback: timedelta) -> Column:
    return F.col("time_generated") > F.lit(as_of - lookback).cast("timestamp")


def slow_queries(
    diagnostics: DataFrame, as_of: datetime, lookback: timedelta = timedelta(hours=24),
    count: int = SLOW_ROWS,
) -> DataFrame:
    """Slowest statements with rows examined per row sent."""
    sent, examined = F.col("rows_sent"), F.col("rows_examined")
    return (
        diagnostics.filter(since(as_of, lookback) & (F.col("category") == SLOW_LOGS))
        .select(
            "time_generated", "resource",
            F.col("db_s").alias("database"),
            F.col("query_time_d").cast("double").alias("query_seconds"),
            F.col("lock_time_d").cast("double").alias("lock_seconds"),
            F.col("rows_sent_d").cast("long").alias("rows_sent"),
            F.col("rows_examined_d").cast("long").alias("rows_examined"),
            F.col("host_s").alias("client_host"),
            F.col("sql_text_s").alias("statement"),
        )
        .withColumn(
            "examined_per_sent",
            F.when(sent > 0, examined * F.lit(1.0) / sent).otherwise(examined.cast("double")),
        )
        .orderBy(F.desc("query_seconds"), F.desc("time_generated"), "resource", "statement")
        .limit(count)
    )


def audit_events(
    diagnostics: DataFrame, as_of: datetime, lookback: timedelta = timedelta(hours=24),
    count: int = AUDIT_ROWS,
) -> DataFrame:
    return (
        diagnostics.filter(since(as_of, lookback) & (F.col("category") == AUDIT_LOGS))
        .select(
            "time_generated", "resource",
            F.col("event_class_s").alias("event_class"),
            F.col("event_subclass_s").alias("event_subclass"),
            F.col("user_s").alias("user"),
            F.col("ip_s").alias("client_ip"),
            F.col("db_s").alias("database"),
            F.col("error_code_d").cast("long").alias("error_code"),
            F.col("is_aad_auth_s").alias("is_directory_auth"),
            F.col("sql_text_s").alias("statement"),
        )
        .orderBy(F.desc("time_generated"), "resource", "user", "statement")
        .limit(count)
    )


def failed_logins(
    diagnostics: DataFrame, as_of: datetime, lookback: timedelta = timedelta(hours=24),
    users: int = LISTED_USERS,
) -> DataFrame:
    """Rejected logins by source address and code, with the first few user names.

    Names are made distinct and cut to the listed ones before any list is built, so a source that
    tries millions of names still gives a short list.
    """
    keys = ["client_ip", "error_code"]
    failed = diagnostics.filter(
        since(as_of, lookback)
        & (F.col("category") == AUDIT_LOGS)
        & (F.col("event_class_s") == CONNECTION_CLASS)
        & (F.col("error_code_d").cast("long") != 0)
    ).select(
        F.col("ip_s").alias("client_ip"),
        F.col("error_code_d").cast("long").alias("error_code"),
        F.col("user_s").alias("user"),
        "time_generated",
    )
    per_user = failed.groupBy(*keys, "user").agg(
        F.count(F.lit(1)).alias("failures"), F.max("time_generated").alias("last_seen")
    )
    totals = per_user.groupBy(*keys).agg(
        F.sum("failures").alias("failures"), F.max("last_seen").alias("last_seen")
    )
    named = (
        per_user.filter(F.col("user").isNotNull())
        .withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy("user")))
        .filter(F.col("_n") <= users)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("user")).alias("users"))
    )
    return totals.join(named, keys, "left").orderBy(F.desc("failures"))


def _metrics(metrics: DataFrame, names: Sequence[str], as_of, lookback) -> DataFrame:
    return metrics.filter(since(as_of, lookback) & F.col("metric_name").isin(*names))


def _time_bin(seconds: int = BIN_SECONDS) -> Column:
    return bin_start(F.col("time_generated"), seconds).alias("time_generated")


def connection_metrics(
    metrics: DataFrame, as_of: datetime, lookback: timedelta = timedelta(hours=24)
) -> DataFrame:
    return (
        _metrics(metrics, CONNECTION_METRICS, as_of, lookback)
        .groupBy(_time_bin(), "metric_name", "resource")
        .agg(
            F.avg("average").alias("avg"),
            F.max("maximum").alias("max"),
            F.sum("total").alias("total"),
        )
        .orderBy("time_generated")
    )


def _pivoted(metrics: DataFrame, names: Sequence[str], as_of, lookback) -> DataFrame:
    """Sum of ``total`` per bin, one column per metric."""
    return (
        _metrics(metrics, names, as_of, lookback)
        .groupBy(_time_bin())
        .pivot("metric_name", list(names))
        .agg(F.sum("total"))
    )


def aborted_ratio(
    metrics: DataFrame, as_of: datetime, lookback: timedelta = timedelta(hours=24)
) -> DataFrame:
    """Aborted connections per connection; 0 in a bin without connections."""
    aborted, total = F.col("aborted_connections"), F.col("total_connections")
    return (
        _pivoted(metrics, ["aborted_connections", "total_connections"], as_of, lookback)
        .withColumn("aborted_ratio", F.when(total > 0, aborted / total).otherwise(0.0))
        .orderBy("time_generated")
    )


def platform_hit_ratio(
    metrics: DataFrame, as_of: datetime, lookback: timedelta = timedelta(hours=24)
) -> DataFrame:
    reads, requests = F.col("Innodb_buffer_pool_reads"), F.col("Innodb_buffer_pool_read_requests")
    names = ["Innodb_buffer_pool_reads", "Innodb_buffer_pool_read_requests"]
    return (
        _pivoted(metrics, names, as_of, lookback)
        .filter(requests > 0)
        .select("time_generated", (F.lit(1.0) - reads / requests).alias("hit_ratio"))
        .orderBy("time_generated")
    )


def cpu_memory(
    metrics: DataFrame, as_of: datetime, lookback: timedelta = timedelta(hours=24)
) -> DataFrame:
    return (
        _metrics(metrics, CPU_MEMORY_METRICS, as_of, lookback)
        .groupBy(_time_bin(), "metric_name", "resource")
        .agg(
            F.round(F.avg("average"), 2).alias("avg"), F.round(F.max("maximum"), 2).alias("max")
        )
        .orderBy("time_generated")
    )


def saturation(
    metrics: DataFrame, as_of: datetime, lookback: timedelta = timedelta(days=7)
) -> DataFrame:
    """Average of averages, and p95 and peak of the per-minute maxima."""
    chosen = _metrics(metrics, SATURATION_METRICS, as_of, lookback)
    keys = ["metric_name", "resource"]
    peaks = distribution(chosen, keys, "maximum", {"p95": 0.95}, {"max": "peak"})
    means = chosen.groupBy(*keys).agg(F.avg("average").alias("avg"))
    return (
        peaks.join(means, keys)
        .select(*keys, *[F.round(c, 1).alias(c) for c in ("avg", "p95", "peak")])
        .orderBy(F.desc("p95"))
    )


def storage_metrics(
    metrics: DataFrame, as_of: datetime, lookback: timedelta = timedelta(hours=24)
) -> DataFrame:
    return (
        _metrics(metrics, STORAGE_METRICS, as_of, lookback)
        .groupBy(_time_bin(), "metric_name", "resource")
        .agg(F.avg("average").alias("avg"), F.max("maximum").alias("max"))
        .orderBy("time_generated")
    )


def storage_headroom(
    metrics: DataFrame, as_of: datetime, lookback: timedelta = timedelta(days=30)
) -> DataFrame:
    return (
        _metrics(metrics, ["storage_percent"], as_of, lookback)
        .groupBy(_time_bin(3600), "resource")
        .agg(F.max("maximum").alias("max_percent"))
        .orderBy("time_generated")
    )


def _activity(activity: DataFrame, as_of, lookback) -> DataFrame:
    return activity.filter(since(as_of, lookback) & (F.col("resource_provider") == PROVIDER))


def platform_events(
    activity: DataFrame, as_of: datetime, lookback: timedelta = timedelta(days=7),
    count: int = ACTIVITY_ROWS,
) -> DataFrame:
    return (
        _activity(activity, as_of, lookback)
        .select(
            "time_generated", "operation_name", "activity_status", "activity_substatus", "caller",
            "caller_ip", "resource_group", F.col("resource_id").alias("resource"),
            "correlation_id",
        )
        .orderBy(F.desc("time_generated"), "correlation_id")
        .limit(count)
    )


def restarts(
    activity: DataFrame, as_of: datetime, lookback: timedelta = timedelta(days=30)
) -> DataFrame:
    """Successful operations that restart or move a server, and so reset its counters."""
    return (
        _activity(activity, as_of, lookback)
        .filter(has_term(F.col("operation_name"), *RESTART_TERMS))
        .filter(F.col("activity_status") == "Success")
        .select("time_generated", "operation_name", "caller", "resource_id")
        .orderBy(F.desc("time_generated"))
    )


def config_changes(
    activity: DataFrame, as_of: datetime, lookback: timedelta = timedelta(days=30)
) -> DataFrame:
    return (
        _activity(activity, as_of, lookback)
        .filter(has_term(F.col("operation_name"), "configurations"))
        .select("time_generated", "operation_name", "activity_status", "caller", "resource_id")
        .orderBy(F.desc("time_generated"))
    )

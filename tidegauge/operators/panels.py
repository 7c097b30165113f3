"""Dashboard panels over the series, point and event tables.

Dashboard parameters are arguments: one run, its targets, and an inclusive time range.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.tags import label, tag
from tidegauge.operators.benchmark import (
    BYTES,
    DIGEST,
    ERRORS,
    FILE_IO,
    OPERATIONS,
    STATUS,
    WAIT,
    file_io_rates,
    weighted_latency,
)
from tidegauge.operators.health import PROBE, collector_health, selected
from tidegauge.operators.ordered import SLICE
from tidegauge.operators.rates import between, multi_rate

# Sizes of the list panels and the bands of the threshold panels.
RECENT_ERRORS = 200
LISTED_ROWS = 100
HEARTBEAT_BANDS = (60, 120)
HIT_RATIO_BANDS = (0.95, 0.99)
BUFFER_READS = "Innodb_buffer_pool_reads"
BUFFER_REQUESTS = "Innodb_buffer_pool_read_requests"


def _samples(
    series: DataFrame, run: str, targets: Sequence[str], measurement: str,
    fields: Sequence[str] | None, start, end,
) -> DataFrame:
    rows = series.filter(
        between(start, end) & selected([run], targets) & (F.col("measurement") == measurement)
    )
    return rows if fields is None else rows.filter(F.col("field").isin(*fields))


def _series_label() -> Column:
    return label(F.col("target_id"), F.col("field")).alias("series")


# --- overview -------------------------------------------------------------------------------


def overview_heartbeat(
    series: DataFrame, metrics: DataFrame, run: str, targets: Sequence[str], as_of: datetime,
    lookback: timedelta = timedelta(days=90),
) -> DataFrame:
    age = F.col("seconds_since_last_beat")
    warn, critical = HEARTBEAT_BANDS
    return (
        collector_health(series, metrics, as_of, lookback)
        .filter(selected([run], targets))
        .select(
            "target_id", age,
            F.when(age >= critical, "critical").when(age >= warn, "warning").otherwise("ok")
            .alias("band"),
        )
    )


def latest_value(
    series: DataFrame, run: str, targets: Sequence[str], field: str, name: str,
    start=None, end=None,
) -> DataFrame:
    """Newest value of one status field per target."""
    return (
        _samples(series, run, targets, STATUS, [field], start, end)
        .groupBy("target_id")
        .agg(F.max_by("value", F.struct("ts", "value")).alias(name))
    )


def latest_threads_connected(series, run, targets, start=None, end=None) -> DataFrame:
    return latest_value(series, run, targets, "Threads_connected", "connected", start, end)


def latest_slow_queries(series, run, targets, start=None, end=None) -> DataFrame:
    return latest_value(series, run, targets, "Slow_queries", "slow_queries", start, end)


def buffer_pool_hit_ratio(
    series: DataFrame, run: str, targets: Sequence[str], start=None, end=None
) -> DataFrame:
    """Newest share of read requests served from memory, per target."""
    rates = multi_rate(
        series, {STATUS: [BUFFER_READS, BUFFER_REQUESTS]}, [run], start, end, targets,
        colocate=["run_id", "target_id"], dimensions={},
    )
    # The rates are already spread by target and slice, so this grouping does not shuffle.
    paired = rates.groupBy("run_id", "target_id", SLICE, "ts").agg(
        F.max(F.when(F.col("field") == BUFFER_READS, F.col("rate"))).alias("reads"),
        F.max(F.when(F.col("field") == BUFFER_REQUESTS, F.col("rate"))).alias("requests"),
    )
    ratio = F.lit(1.0) - F.col("reads") / F.col("requests")
    low, high = HIT_RATIO_BANDS
    return (
        paired.filter(F.col("reads").isNotNull() & (F.col("requests") > 0))
        .groupBy("target_id")
        .agg(F.max_by(ratio, F.struct(F.col("ts"), ratio)).alias("hit_ratio"))
        .withColumn(
            "band",
            F.when(F.col("hit_ratio") >= high, "ok")
            .when(F.col("hit_ratio") >= low, "warning")
            .otherwise("critical"),
        )
    )


def status_rate(
    series: DataFrame, run: str, targets: Sequence[str], field: str, name: str,
    start=None, end=None,
) -> DataFrame:
    """Rate of one status counter by time and target."""
    return (
        multi_rate(series, {STATUS: [field]}, [run], start, end, targets, dimensions={})
        .select("ts", "target_id", F.col("rate").alias(name))
        .orderBy("ts")
    )


def qps_series(series, run, targets, start=None, end=None) -> DataFrame:
    return status_rate(series, run, targets, "Queries", "qps", start, end)


def redo_waits(series, run, targets, start=None, end=None) -> DataFrame:
    return status_rate(series, run, targets, "Innodb_log_waits", "waits_per_second", start, end)


def threads_series(series, run, targets, start=None, end=None) -> DataFrame:
    fields = ["Threads_connected", "Threads_running", "Threads_cached", "Max_used_connections"]
    return (
        _samples(series, run, targets, STATUS, fields, start, end)
        .select("ts", _series_label(), "value")
        .orderBy("ts")
    )


def labelled_rates(
    series: DataFrame, run: str, targets: Sequence[str], fields: Sequence[str],
    start=None, end=None,
) -> DataFrame:
    """Rates of several status counters, one legend entry per target and field."""
    return (
        multi_rate(series, {STATUS: list(fields)}, [run], start, end, targets, dimensions={})
        .select("ts", _series_label(), "rate")
        .orderBy("ts")
    )


def row_operations(series, run, targets, start=None, end=None) -> DataFrame:
    fields = ["Innodb_rows_read", "Innodb_rows_inserted", "Innodb_rows_updated",
              "Innodb_rows_deleted"]
    return labelled_rates(series, run, targets, fields, start, end)


def connection_errors(series, run, targets, start=None, end=None) -> DataFrame:
    return labelled_rates(
        series, run, targets, ["Aborted_connects", "Aborted_clients"], start, end
    )


def recent_errors(
    points: DataFrame, events: DataFrame, run: str, targets: Sequence[str],
    start=None, end=None, count: int = RECENT_ERRORS,
) -> DataFrame:
    """Newest events of the hosts of the chosen targets, once per target of a host."""
    hosts = points.filter(selected([run], targets)).select("target_id", "host").distinct()
    return (
        events.filter(between(start, end) & (F.col("run_id") == run))
        .select("ts", "host", "level", "error_code", "subsystem", "message")
        .join(hosts, "host")
        .select("ts", "target_id", "level", "error_code", "subsystem", "message")
        .orderBy(F.desc("ts"), "target_id", "error_code", "message")
        .limit(count)
    )


# --- query performance ----------------------------------------------------------------------


def worst_tail(
    series: DataFrame, run: str, targets: Sequence[str], field: str, name: str,
    start=None, end=None,
) -> DataFrame:
    """Largest tail latency in the newest snapshot of each target."""
    return (
        _samples(series, run, targets, DIGEST, [field], start, end)
        .groupBy("target_id", "ts")
        .agg(F.max("value").alias("worst"))
        .groupBy("target_id")
        .agg(F.max_by("worst", "ts").alias(name))
    )


def worst_p95(series, run, targets, start=None, end=None) -> DataFrame:
    return worst_tail(series, run, targets, "latency_p95_ms", "worst_p95_ms", start, end)


def worst_p99(series, run, targets, start=None, end=None) -> DataFrame:
    return worst_tail(series, run, targets, "latency_p99_ms", "worst_p99_ms", start, end)


def latest_digest_rate(
    series: DataFrame, run: str, targets: Sequence[str], field: str, name: str,
    start=None, end=None,
) -> DataFrame:
    """Newest sum over all digests of a counter's rate, per target."""
    return (
        multi_rate(series, {DIGEST: [field]}, [run], start, end, targets, dimensions={})
        .groupBy("target_id", "ts")
        .agg(F.sum("rate").alias("rate"))
        .groupBy("target_id")
        .agg(F.max_by("rate", "ts").alias(name))
    )


def statement_error_rate(series, run, targets, start=None, end=None) -> DataFrame:
    return latest_digest_rate(series, run, targets, ERRORS, "errors_per_second", start, end)


def no_index_rate(series, run, targets, start=None, end=None) -> DataFrame:
    return latest_digest_rate(
        series, run, targets, "no_index_used_total", "no_index_per_second", start, end
    )


def top_digests(
    series: DataFrame, run: str, targets: Sequence[str], start=None, end=None,
    count: int = LISTED_ROWS,
) -> DataFrame:
    """Digests of each target's newest snapshot, slowest p99 first."""
    rows = _samples(series, run, targets, DIGEST, None, start, end)
    newest = rows.groupBy("target_id").agg(F.max("ts").alias("ts"))

    def value_of(field: str, name: str) -> Column:
        return F.max(F.when(F.col("field") == field, F.col("value"))).alias(name)

    return (
        rows.join(newest, ["target_id", "ts"])
        .groupBy("target_id", tag("schema").alias("schema"), tag("digest").alias("digest"))
        .agg(
            value_of("executions_total", "executions"),
            value_of("latency_p95_ms", "p95_ms"),
            value_of("latency_p99_ms", "p99_ms"),
            value_of(ERRORS, "errors"),
            value_of("rows_examined_total", "rows_examined"),
        )
        .orderBy(F.desc("p99_ms"), "target_id", "schema", "digest")
        .limit(count)
    )


def tail_series(series, run, targets, start=None, end=None) -> DataFrame:
    fields = ["latency_p95_ms", "latency_p99_ms"]
    return (
        _samples(series, run, targets, DIGEST, fields, start, end)
        .groupBy("ts", "target_id", "field")
        .agg(F.max("value").alias("latency_ms"))
        .select("ts", _series_label(), "latency_ms")
        .orderBy("ts")
    )


def tmp_and_no_index(series, run, targets, start=None, end=None) -> DataFrame:
    fields = ["tmp_disk_tables_total", "no_index_used_total"]
    return (
        multi_rate(series, {DIGEST: fields}, [run], start, end, targets, dimensions={})
        .groupBy("ts", "target_id", "field")
        .agg(F.sum("rate").alias("rate"))
        .select("ts", _series_label(), "rate")
        .orderBy("ts")
    )


# --- storage --------------------------------------------------------------------------------


def mode_iops(series, run, targets, mode: str, start=None, end=None) -> DataFrame:
    """File operations per second of one mode, by time and target."""
    return (
        multi_rate(
            series, {FILE_IO: [OPERATIONS]}, [run], start, end, targets,
            where=tag("mode") == mode, dimensions={},
        )
        .groupBy("ts", "target_id")
        .agg(F.sum("rate").alias("iops"))
        .orderBy("ts")
    )


def read_iops(series, run, targets, start=None, end=None) -> DataFrame:
    return mode_iops(series, run, targets, "read", start, end)


def write_iops(series, run, targets, start=None, end=None) -> DataFrame:
    return mode_iops(series, run, targets, "write", start, end)


def file_throughput(series, run, targets, start=None, end=None) -> DataFrame:
    return (
        multi_rate(
            series, {FILE_IO: [BYTES]}, [run], start, end, targets,
            where=tag("mode").isin("read", "write"), dimensions={"mode": tag("mode")},
        )
        .groupBy("ts", "target_id", "mode")
        .agg(F.sum("rate").alias("bytes_per_second"))
        .select("ts", label(F.col("target_id"), F.col("mode")).alias("series"), "bytes_per_second")
        .orderBy("ts")
    )


def file_latency(series, run, targets, start=None, end=None) -> DataFrame:
    paired = file_io_rates(series, [run], [OPERATIONS, WAIT], start, end, targets)
    return (
        weighted_latency(paired, ["ts", "target_id", "mode"])
        .select("ts", label(F.col("target_id"), F.col("mode")).alias("series"), "latency_ms")
        .orderBy("ts")
    )


def file_classes(
    series, run, targets, start=None, end=None, count: int = LISTED_ROWS
) -> DataFrame:
    """Work and latency of each file class and mode, most waiting first."""
    rates = multi_rate(
        series, {FILE_IO: [OPERATIONS, WAIT]}, [run], start, end, targets,
        dimensions={"event": tag("event"), "mode": tag("mode")},
    )
    ops, wait = F.col("field") == OPERATIONS, F.col("field") == WAIT
    latency = F.when(F.col("operations") > 0, F.col("wait_ms") / F.col("operations"))
    return (
        rates.groupBy("target_id", "series_key", "event", "mode")
        .agg(
            F.avg(F.when(ops, F.col("rate"))).alias("iops"),
            F.sum(F.when(ops, F.col("delta"))).alias("operations"),
            F.sum(F.when(wait, F.col("delta"))).alias("wait_ms"),
        )
        .filter(F.col("operations").isNotNull() & F.col("wait_ms").isNotNull())
        .orderBy(F.desc("wait_ms"), "target_id", "series_key")
        .limit(count)
        .select(
            "target_id", "event", "mode",
            F.round("iops", 2).alias("iops"),
            F.round(F.coalesce(latency, F.lit(0.0)), 3).alias("avg_latency_ms"),
            "operations",
        )
    )


# --- variables ------------------------------------------------------------------------------


def run_list(points: DataFrame) -> DataFrame:
    """Runs by last sample, newest first."""
    return (
        points.filter(F.col("run_id") != PROBE)
        .groupBy("run_id")
        .agg(F.max("ts").alias("last_seen"))
        .orderBy(F.desc("last_seen"))
        .select("run_id")
    )


def target_list(points: DataFrame, run: str) -> DataFrame:
    return (
        points.filter((F.col("run_id") == run) & (F.col("target_id") != PROBE))
        .select("target_id")
        .distinct()
        .orderBy("target_id")
    )

"""Metric catalog: what every measurement, tag and field means."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    unit: str
    value_type: str
    series: bool = True
    required: bool = True


@dataclass(frozen=True)
class Measurement:
    name: str
    tags: tuple[str, ...]
    cardinality: str
    fields: tuple[Field, ...]


# Status variables in server order, and which of them are gauges, bytes or times.
STATUS_NAMES = [
    "Innodb_data_reads", "Innodb_data_writes", "Innodb_data_read", "Innodb_data_written",
    "Innodb_data_fsyncs", "Innodb_data_pending_reads", "Innodb_data_pending_writes",
    "Innodb_data_pending_fsyncs", "Innodb_pages_read", "Innodb_pages_written",
    "Innodb_pages_created", "Innodb_os_log_written", "Innodb_os_log_fsyncs",
    "Innodb_os_log_pending_fsyncs", "Innodb_os_log_pending_writes", "Innodb_log_writes",
    "Innodb_log_write_requests", "Innodb_log_waits", "Innodb_buffer_pool_read_requests",
    "Innodb_buffer_pool_reads", "Innodb_buffer_pool_write_requests",
    "Innodb_buffer_pool_pages_total", "Innodb_buffer_pool_pages_free",
    "Innodb_buffer_pool_pages_dirty", "Innodb_buffer_pool_pages_data",
    "Innodb_buffer_pool_bytes_dirty", "Innodb_buffer_pool_wait_free", "Innodb_rows_read",
    "Innodb_rows_inserted", "Innodb_rows_updated", "Innodb_rows_deleted", "Innodb_row_lock_waits",
    "Innodb_row_lock_time", "Innodb_row_lock_time_avg", "Innodb_row_lock_current_waits",
    "Threads_connected", "Threads_running", "Threads_created", "Threads_cached", "Connections",
    "Aborted_connects", "Aborted_clients", "Max_used_connections", "Queries", "Questions",
    "Slow_queries", "Com_select", "Com_insert", "Com_update", "Com_delete", "Com_commit",
    "Com_rollback", "Com_begin", "Prepared_stmt_count", "Bytes_received", "Bytes_sent",
    "Handler_read_first", "Handler_read_key", "Handler_read_next", "Handler_read_rnd",
    "Handler_read_rnd_next", "Handler_write", "Handler_update", "Handler_delete", "Handler_commit",
    "Handler_rollback", "Created_tmp_tables", "Created_tmp_disk_tables", "Created_tmp_files",
    "Select_scan", "Select_full_join", "Select_range", "Sort_merge_passes", "Sort_rows",
    "Sort_scan", "Table_locks_waited", "Table_locks_immediate", "Table_open_cache_hits",
    "Table_open_cache_misses", "Open_tables", "Opened_tables", "Binlog_cache_use",
    "Binlog_cache_disk_use", "Ssl_accepts", "Ssl_finished_accepts", "Uptime",
]
STATUS_GAUGES = [
    "Innodb_data_pending_reads", "Innodb_data_pending_writes", "Innodb_data_pending_fsyncs",
    "Innodb_os_log_pending_fsyncs", "Innodb_os_log_pending_writes",
    "Innodb_buffer_pool_pages_total", "Innodb_buffer_pool_pages_free",
    "Innodb_buffer_pool_pages_dirty", "Innodb_buffer_pool_pages_data",
    "Innodb_buffer_pool_bytes_dirty", "Innodb_row_lock_current_waits", "Innodb_row_lock_time_avg",
    "Threads_connected", "Threads_running", "Threads_cached", "Max_used_connections",
    "Prepared_stmt_count", "Open_tables", "Uptime",
]
STATUS_BYTES = [
    "Innodb_data_read", "Innodb_data_written", "Innodb_os_log_written",
    "Innodb_buffer_pool_bytes_dirty", "Bytes_received", "Bytes_sent",
]
STATUS_MILLISECONDS = ["Innodb_row_lock_time", "Innodb_row_lock_time_avg"]

# Measurements with their tags, cardinality and fields.
MEASUREMENTS = [
    Measurement("collector.health", (), "low", (
        Field("heartbeat", "gauge", "state", "float"),
        Field("mysql_reachable", "gauge", "state", "float"),
        Field("cycle_duration_ms", "gauge", "ms", "float", required=False),
    )),
    Measurement("mysql.file_io", ("event", "mode"), "bounded", (
        Field("operations_total", "counter", "operations", "int"),
        Field("bytes_total", "counter", "bytes", "int"),
        Field("wait_ms_total", "counter", "ms", "float"),
    )),
    Measurement("mysql.statement_digest", ("schema", "digest"), "high", (
        Field("executions_total", "counter", "executions", "int"),
        Field("latency_ms_total", "counter", "ms", "float"),
        Field("lock_ms_total", "counter", "ms", "float"),
        Field("rows_examined_total", "counter", "rows", "int"),
        Field("rows_sent_total", "counter", "rows", "int"),
        Field("errors_total", "counter", "errors", "int"),
        Field("warnings_total", "counter", "warnings", "int"),
        Field("tmp_tables_total", "counter", "tables", "int"),
        Field("tmp_disk_tables_total", "counter", "tables", "int"),
        Field("no_index_used_total", "counter", "executions", "int"),
        Field("latency_p95_ms", "gauge", "ms", "float"),
        Field("latency_p99_ms", "gauge", "ms", "float"),
    )),
    Measurement("mysql.innodb_metric", ("name", "subsystem", "metric_type"), "bounded", (
        Field("counter_value", "counter", "value", "int", required=False),
        Field("gauge_value", "gauge", "value", "float", required=False),
    )),
    Measurement("mysql.global_variable", ("name",), "bounded", (
        Field("numeric_value", "gauge", "value", "float", required=False),
        Field("text_value", "state", "text", "str", series=False, required=False),
    )),
    Measurement("mysql.process_state", ("command", "state"), "bounded", (
        Field("sessions", "gauge", "sessions", "int"),
        Field("oldest_seconds", "gauge", "s", "int"),
    )),
    Measurement("mysql.schema_size", ("schema", "table", "engine"), "high", (
        Field("rows_estimate", "gauge", "rows", "int"),
        Field("data_bytes", "gauge", "bytes", "int"),
        Field("index_bytes", "gauge", "bytes", "int"),
        Field("free_bytes", "gauge", "bytes", "int"),
    )),
    Measurement("mysql.table_io", ("schema", "table"), "high", (
        Field("fetch_total", "counter", "operations", "int"),
        Field("fetch_wait_ms_total", "counter", "ms", "float"),
        Field("insert_total", "counter", "operations", "int"),
        Field("insert_wait_ms_total", "counter", "ms", "float"),
        Field("update_total", "counter", "operations", "int"),
        Field("update_wait_ms_total", "counter", "ms", "float"),
        Field("delete_total", "counter", "operations", "int"),
        Field("delete_wait_ms_total", "counter", "ms", "float"),
    )),
    Measurement("mysql.index_io", ("schema", "table", "index"), "high", (
        Field("fetch_total", "counter", "operations", "int"),
        Field("fetch_wait_ms_total", "counter", "ms", "float"),
    )),
]


def _status_unit(name: str) -> str:
    known = {
        **dict.fromkeys(STATUS_BYTES, "bytes"),
        **dict.fromkeys(STATUS_MILLISECONDS, "ms"),
        "Uptime": "s",
    }
    if name in known:
        return known[name]
    if "pages" in name.lower():
        return "pages"
    return "threads" if name.startswith("Threads_") else "operations"


def _status() -> Measurement:
    fields = tuple(
        Field(n, "gauge" if n in STATUS_GAUGES else "counter", _status_unit(n), "float",
              required=False)
        for n in STATUS_NAMES
    )
    return Measurement("mysql.global_status", (), "low", fields)


CATALOG = {m.name: m for m in [*MEASUREMENTS, _status()]}

_FIELD_SPEC = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("value_type", T.StringType()),
    T.StructField("series", T.BooleanType()),
])
CATALOG_SCHEMA = T.StructType([
    T.StructField("measurement", T.StringType()),
    T.StructField("known_tags", T.ArrayType(T.StringType())),
    T.StructField("known_fields", T.ArrayType(T.StringType())),
    T.StructField("required_fields", T.ArrayType(T.StringType())),
    T.StructField("specs", T.MapType(T.StringType(), _FIELD_SPEC)),
])
FIELD_SCHEMA = (
    "measurement string, field string, kind string, unit string, value_type string, "
    "series boolean, required boolean, cardinality string"
)


def catalog_frame(spark: SparkSession) -> DataFrame:
    """One row per measurement. Ten rows by definition, so it may always be broadcast."""
    rows = [
        (
            m.name, list(m.tags), [f.name for f in m.fields],
            [f.name for f in m.fields if f.required],
            {f.name: (f.kind, f.unit, f.value_type, f.series) for f in m.fields},
        )
        for m in CATALOG.values()
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def field_frame(spark: SparkSession) -> DataFrame:
    """One row per catalog field."""
    rows = [
        (m.name, f.name, f.kind, f.unit, f.value_type, f.series, f.required, m.cardinality)
        for m in CATALOG.values()
        for f in m.fields
    ]
    return spark.createDataFrame(rows, FIELD_SCHEMA)

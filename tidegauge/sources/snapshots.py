"""Scans of server snapshot tables, exported or over JDBC.

The source-side filters of the collector are part of the scan: over JDBC they travel in the query,
on exported tables they are pushed into the file scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.catalog import STATUS_NAMES
from tidegauge.operators.audits import TOP_K
from tidegauge.operators.normalize import POLL, SYSTEM_SCHEMAS

# Server tables, the columns read of them, and the rows left at the source.
_NOT_SYSTEM = "{} NOT IN (" + ", ".join(f"'{s}'" for s in SYSTEM_SCHEMAS) + ")"
_NAMES = ", ".join(f"'{n}'" for n in STATUS_NAMES)
SCANS: Mapping[str, tuple[str, tuple[str, ...], str]] = {
    "status": (
        "performance_schema.global_status", ("variable_name", "variable_value"),
        f"variable_name IN ({_NAMES})",
    ),
    "files": (
        "performance_schema.file_summary_by_event_name",
        (
            "event_name", "count_star", "sum_timer_wait", "count_read",
            "sum_number_of_bytes_read", "sum_timer_read", "count_write",
            "sum_number_of_bytes_write", "sum_timer_write", "count_misc", "sum_timer_misc"
        ),
        "count_star > 0",
    ),
    "digests": (
        "performance_schema.events_statements_summary_by_digest",
        (
            "schema_name", "digest", "count_star", "sum_timer_wait", "sum_lock_time",
            "sum_rows_examined", "sum_rows_sent", "sum_errors", "sum_warnings",
            "sum_created_tmp_tables", "sum_created_tmp_disk_tables", "sum_no_index_used",
            "quantile_95", "quantile_99"
        ),
        "digest IS NOT NULL",
    ),
    "engine_metrics": (
        "information_schema.innodb_metrics", ("name", "subsystem", "type", "status", "count"),
        "status = 'enabled'",
    ),
    "variables": ("performance_schema.global_variables", ("variable_name", "variable_value"), "1 = 1"),
    "sessions": ("information_schema.processlist", ("command", "state", "time"), "1 = 1"),
    "tables": (
        "information_schema.tables",
        (
            "table_schema", "table_name", "engine", "table_type", "table_rows",
            "data_length", "index_length", "data_free"
        ),
        "table_type = 'BASE TABLE' AND engine IS NOT NULL AND "
        + _NOT_SYSTEM.format("table_schema"),
    ),
    "table_io": (
        "performance_schema.table_io_waits_summary_by_table",
        (
            "object_schema", "object_name", "count_star", "sum_timer_wait", "count_fetch",
            "sum_timer_fetch", "count_insert", "sum_timer_insert", "count_update",
            "sum_timer_update", "count_delete", "sum_timer_delete"
        ),
        "count_star > 0 AND " + _NOT_SYSTEM.format("object_schema"),
    ),
    "index_io": (
        "performance_schema.table_io_waits_summary_by_index_usage",
        (
            "object_schema", "object_name", "index_name", "count_star", "sum_timer_wait",
            "count_fetch", "sum_timer_fetch"
        ),
        "index_name IS NOT NULL AND count_star > 0 AND " + _NOT_SYSTEM.format("object_schema"),
    ),
    "error_log": (
        "performance_schema.error_log", ("logged", "prio", "error_code", "subsystem", "data"), "1 = 1",
    ),
}


def scan_snapshot(exported: DataFrame, name: str) -> DataFrame:
    """The rows and columns the collector reads of an exported server table."""
    _, columns, condition = SCANS[name]
    context = [c for c in POLL if c in exported.columns]
    return exported.filter(F.expr(condition)).select(*context, *columns)


def read_snapshot(spark: SparkSession, name: str, path: str) -> DataFrame:
    return scan_snapshot(spark.read.parquet(path), name)


#: The order in which a server sends the rows of the scans that have a limit, and the
#: measurement whose limit it is.
RANKED: Mapping[str, tuple[str, str]] = {
    "files": ("sum_timer_wait", "mysql.file_io"),
    "digests": ("sum_timer_wait", "mysql.statement_digest"),
    "tables": ("data_length + index_length", "mysql.schema_size"),
    "table_io": ("sum_timer_wait", "mysql.table_io"),
    "index_io": ("sum_timer_wait", "mysql.index_io"),
}


def jdbc_query(name: str, top_k: int | None = None) -> str:
    """Text sent to a server. Reserved column names are quoted the server's way; scans that keep
    the busiest or largest rows are ordered and cut by the server (``top_k`` of them, or as many
    as the operators keep)."""
    table, columns, condition = SCANS[name]
    listed = ", ".join(f"`{c}`" for c in columns)
    text = f"SELECT {listed} FROM {table} WHERE {condition}"
    if name in RANKED:
        order, measurement = RANKED[name]
        text += f" ORDER BY {order} DESC LIMIT {int(top_k or TOP_K[measurement])}"
    return text


def read_snapshot_jdbc(
    spark: SparkSession, name: str, url: str, context: Mapping[str, str],
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """One poll of one server, as a frame with its context. Needs the server's JDBC driver."""
    rows = (
        spark.read.format("jdbc").option("url", url).option("query", jdbc_query(name))
        .options(**dict(options or {})).load()
    )
    lower = rows.toDF(*[c.lower() for c in rows.columns])
    return lower.withColumns({
        **{k: F.lit(v) for k, v in context.items()}, "observed_at": F.current_timestamp(),
    })

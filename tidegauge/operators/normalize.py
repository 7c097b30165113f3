"""Server snapshots to points.

A snapshot frame holds the polls of any number of servers: context columns, ``observed_at``, and
the columns of the server table in lower case. A per-poll limit becomes a ranking inside
(run, target, poll); Spark cuts each task's rows to the limit before it shuffles them. Ties keep
the natural key in order. Pico-seconds become milliseconds here, once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegauge.catalog import STATUS_NAMES
from tidegauge.functions.scalars import filled, parse_double
from tidegauge.operators.audits import TOP_K
from tidegauge.schemas import CONTEXT

# Unit of server timers, schemas left out, counter types, legacy limit.
PICOSECONDS_PER_MS = 1_000_000_000
SYSTEM_SCHEMAS = ("mysql", "information_schema", "performance_schema", "sys")
COUNTER_TYPES = ("counter", "status_counter")
LEGACY_DIGESTS = 20
LEGACY_DIGEST_CHARS = 16

POLL = (*CONTEXT, "observed_at")


def count_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(0).cast("long"))


def ms_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("double"), F.lit(0.0)) / F.lit(float(PICOSECONDS_PER_MS))


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("None"))


def _fields(fields: Mapping[str, Column]) -> Column:
    """Map of variants; counts stay integers, times stay reals."""
    return F.map_from_arrays(
        F.array(*[F.lit(n) for n in fields]),
        F.array(*[c.cast("variant") for c in fields.values()]),
    )


def _tags(tags: Mapping[str, Column]) -> Column:
    if not tags:
        return F.create_map().cast("map<string,string>")
    return F.map_from_arrays(F.array(*[F.lit(n) for n in tags]), F.array(*tags.values()))


def _points(rows: DataFrame, measurement: str, fields: Column, tags: Mapping[str, Column]):
    return rows.select(
        F.col("observed_at").alias("ts"),
        *CONTEXT,
        F.lit(measurement).alias("measurement"),
        _tags(tags).alias("tags"),
        fields.alias("fields"),
    )


def top_per_poll(rows: DataFrame, count: int, order: Column, *ties: str) -> DataFrame:
    """The first rows of every poll in the given order."""
    rank = F.row_number().over(
        W.partitionBy("run_id", "target_id", "observed_at").orderBy(order, *ties)
    )
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= count).drop("_rank")


def not_system(column: str) -> Column:
    """Like SQL NOT IN, this drops null schemas too."""
    return ~F.col(column).isin(*SYSTEM_SCHEMAS)


def norm_global_status(status: DataFrame) -> DataFrame:
    """One wide point per poll with the numeric status variables of the catalog.

    A poll holds a name once; duplicates are merged first, so a list never exceeds the catalog.
    """
    value = parse_double(F.col("variable_value"))
    polls = (
        status.filter(F.col("variable_name").isin(*STATUS_NAMES) & value.isNotNull())
        .groupBy(*POLL, "variable_name")
        .agg(F.max(value).alias("number"))
        .groupBy(*POLL)
        .agg(F.map_from_entries(F.collect_list(F.struct("variable_name", "number"))).alias("m"))
    )
    fields = F.transform_values("m", lambda _, v: v.cast("variant"))
    return _points(polls, "mysql.global_status", fields, {})


def norm_file_io(files: DataFrame, top_k: int = TOP_K["mysql.file_io"]) -> DataFrame:
    """Three points per file class, one for each of read, write and misc."""
    busiest = top_per_poll(
        files.filter(F.col("count_star") > 0), top_k, F.desc("sum_timer_wait"), "event_name"
    )
    modes = F.array(*[
        F.struct(
            F.lit(mode).alias("mode"), count_of(count).alias("operations"),
            (count_of(size) if size else F.lit(0).cast("long")).alias("bytes"),
            ms_of(timer).alias("wait_ms"),
        )
        for mode, count, size, timer in (
            ("read", "count_read", "sum_number_of_bytes_read", "sum_timer_read"),
            ("write", "count_write", "sum_number_of_bytes_write", "sum_timer_write"),
            ("misc", "count_misc", None, "sum_timer_misc"),
        )
    ])
    rows = busiest.select(*POLL, "event_name", F.inline(modes))
    return _points(
        rows, "mysql.file_io",
        _fields({
            "operations_total": F.col("operations"), "bytes_total": F.col("bytes"),
            "wait_ms_total": F.col("wait_ms"),
        }),
        {"event": text_of("event_name"), "mode": F.col("mode")},
    )


def norm_statement_digest(
    digests: DataFrame, top_k: int = TOP_K["mysql.statement_digest"]
) -> DataFrame:
    busiest = top_per_poll(
        digests.filter(F.col("digest").isNotNull()), top_k, F.desc("sum_timer_wait"),
        "schema_name", "digest",
    )
    return _points(
        busiest, "mysql.statement_digest",
        _fields({
            "executions_total": count_of("count_star"),
            "latency_ms_total": ms_of("sum_timer_wait"),
            "lock_ms_total": ms_of("sum_lock_time"),
            "rows_examined_total": count_of("sum_rows_examined"),
            "rows_sent_total": count_of("sum_rows_sent"),
            "errors_total": count_of("sum_errors"),
            "warnings_total": count_of("sum_warnings"),
            "tmp_tables_total": count_of("sum_created_tmp_tables"),
            "tmp_disk_tables_total": count_of("sum_created_tmp_disk_tables"),
            "no_index_used_total": count_of("sum_no_index_used"),
            "latency_p95_ms": ms_of("quantile_95"),
            "latency_p99_ms": ms_of("quantile_99"),
        }),
        {"schema": filled(F.col("schema_name"), "(none)"), "digest": text_of("digest")},
    )


def norm_innodb_metric(metrics: DataFrame) -> DataFrame:
    """Enabled engine metrics; counters and gauges go to different fields."""
    counter = F.col("type").isin(*COUNTER_TYPES)
    number = F.coalesce(F.col("count").cast("double"), F.lit(0.0))
    fields = F.when(counter, _fields({"counter_value": count_of("count")})).otherwise(
        _fields({"gauge_value": number})
    )
    return _points(
        metrics.filter(F.col("status") == "enabled"), "mysql.innodb_metric", fields,
        {"name": text_of("name"), "subsystem": text_of("subsystem"),
         "metric_type": text_of("type")},
    )


def norm_global_variable(variables: DataFrame) -> DataFrame:
    """Numeric settings as a gauge, all others as text."""
    number = parse_double(F.col("variable_value"))
    fields = F.when(number.isNotNull(), _fields({"numeric_value": number})).otherwise(
        _fields({"text_value": text_of("variable_value")})
    )
    return _points(
        variables, "mysql.global_variable", fields, {"name": text_of("variable_name")}
    )


def norm_process_state(sessions: DataFrame) -> DataFrame:
    """Sessions and the oldest of them by raw command and state."""
    grouped = sessions.groupBy(*POLL, "command", "state").agg(
        F.count(F.lit(1)).alias("sessions"), F.max("time").alias("oldest")
    )
    return _points(
        grouped, "mysql.process_state",
        _fields({"sessions": F.col("sessions"), "oldest_seconds": count_of("oldest")}),
        {"command": filled(F.col("command"), "(none)"), "state": filled(F.col("state"), "(none)")},
    )


def norm_schema_size(tables: DataFrame, top_k: int = TOP_K["mysql.schema_size"]) -> DataFrame:
    """Largest base tables by data and index bytes."""
    base = tables.filter(
        (F.col("table_type") == "BASE TABLE")
        & F.col("engine").isNotNull()
        & not_system("table_schema")
    )
    largest = top_per_poll(
        base, top_k, (F.col("data_length") + F.col("index_length")).desc_nulls_last(),
        "table_schema", "table_name",
    )
    return _points(
        largest, "mysql.schema_size",
        _fields({
            "rows_estimate": count_of("table_rows"), "data_bytes": count_of("data_length"),
            "index_bytes": count_of("index_length"), "free_bytes": count_of("data_free"),
        }),
        {"schema": text_of("table_schema"), "table": text_of("table_name"),
         "engine": text_of("engine")},
    )


def _io_fields(operations: Sequence[str]) -> Column:
    fields = {}
    for operation in operations:
        fields[f"{operation}_total"] = count_of(f"count_{operation}")
        fields[f"{operation}_wait_ms_total"] = ms_of(f"sum_timer_{operation}")
    return _fields(fields)


def norm_table_io(tables: DataFrame, top_k: int = TOP_K["mysql.table_io"]) -> DataFrame:
    used = tables.filter(not_system("object_schema") & (F.col("count_star") > 0))
    busiest = top_per_poll(
        used, top_k, F.desc("sum_timer_wait"), "object_schema", "object_name"
    )
    return _points(
        busiest, "mysql.table_io", _io_fields(["fetch", "insert", "update", "delete"]),
        {"schema": text_of("object_schema"), "table": text_of("object_name")},
    )


def norm_index_io(indexes: DataFrame, top_k: int = TOP_K["mysql.index_io"]) -> DataFrame:
    used = indexes.filter(
        not_system("object_schema") & F.col("index_name").isNotNull() & (F.col("count_star") > 0)
    )
    busiest = top_per_poll(
        used, top_k, F.desc("sum_timer_wait"), "object_schema", "object_name", "index_name"
    )
    return _points(
        busiest, "mysql.index_io", _io_fields(["fetch"]),
        {"schema": text_of("object_schema"), "table": text_of("object_name"),
         "index": text_of("index_name")},
    )


def _legacy(rows: DataFrame, source: str, metric: Column, value: Column) -> DataFrame:
    return rows.select(
        F.col("observed_at").alias("ts"), "run_id", "host", "tier",
        F.lit(source).alias("source"), metric.alias("metric"), value.alias("value"),
    )


def norm_status_legacy(status: DataFrame) -> DataFrame:
    """Narrow legacy rows of the numeric status variables of the catalog."""
    value = parse_double(F.col("variable_value"))
    chosen = status.filter(F.col("variable_name").isin(*STATUS_NAMES) & value.isNotNull())
    return _legacy(chosen, "global_status", F.col("variable_name"), value)


def norm_digest_legacy(digests: DataFrame, top_k: int = LEGACY_DIGESTS) -> DataFrame:
    """Six legacy rows per busy digest, named after the start of its hash."""
    busiest = top_per_poll(
        digests.filter(F.col("digest").isNotNull() & not_system("schema_name")), top_k,
        F.desc("sum_timer_wait"), "schema_name", "digest",
    )
    measured = {
        "count": count_of("count_star").cast("double"),
        "latency_ms": ms_of("sum_timer_wait"),
        "lock_ms": ms_of("sum_lock_time"),
        "rows_examined": count_of("sum_rows_examined").cast("double"),
        "rows_sent": count_of("sum_rows_sent").cast("double"),
        "no_index_used": count_of("sum_no_index_used").cast("double"),
    }
    rows = busiest.select(
        *POLL, "digest",
        F.inline(F.array(*[
            F.struct(F.lit(name).alias("name"), value.alias("number"))
            for name, value in measured.items()
        ])),
    )
    key = F.substring(filled(F.col("digest"), "unknown"), 1, LEGACY_DIGEST_CHARS)
    metric = F.concat(F.lit("digest."), key, F.lit("."), F.col("name"))
    return _legacy(rows, "ps_digest", metric, F.col("number"))


def norm_error_event(log: DataFrame) -> DataFrame:
    """Error-log rows to events; missing text becomes empty."""

    def text(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(""))

    return log.select(
        F.col("logged").alias("ts"), "run_id", "target_id", "host", "tier",
        F.lit("error_log").alias("source"), text("prio").alias("level"),
        text("error_code").alias("error_code"), text("subsystem").alias("subsystem"),
        text("data").alias("message"), "collector_id",
    )


def norm_health_point(cycles: DataFrame) -> DataFrame:
    """Heartbeat point per cycle (reachable, duration_ms); the duration may be missing."""
    beat = {
        "heartbeat": F.lit(1.0),
        "mysql_reachable": F.when(F.col("reachable"), F.lit(1.0)).otherwise(F.lit(0.0)),
    }
    timed = {**beat, "cycle_duration_ms": F.col("duration_ms").cast("double")}
    fields = F.when(F.col("duration_ms").isNotNull(), _fields(timed)).otherwise(_fields(beat))
    return _points(cycles, "collector.health", fields, {})

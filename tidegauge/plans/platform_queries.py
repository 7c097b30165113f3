"""Platform-log queries, alerts and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions.timing import utc_iso
from tidegauge.operators import alerts, audits
from tidegauge.operators import platform as p
from tidegauge.plans.fixtures import AS_OF, LOOKBACK, START
from tidegauge.plans.registry import half_up, query, r

NOW = f"TIMESTAMP '{AS_OF}'"


@query(
    "slow_queries",
    f"""
    SELECT time_generated, resource, db_s AS database, {r('query_time_d', 'query_seconds')},
           {r('lock_time_d', 'lock_seconds')}, CAST(rows_sent_d AS BIGINT) AS rows_sent,
           CAST(rows_examined_d AS BIGINT) AS rows_examined,
           {r('''CASE WHEN rows_sent_d > 0 THEN rows_examined_d * 1e0 / rows_sent_d
                 ELSE rows_examined_d END''', 'examined_per_sent')},
           host_s AS client_host, sql_text_s AS statement
    FROM slow_log ORDER BY query_time_d DESC, time_generated DESC, resource, statement LIMIT 200
    """,
)
def _slow_queries(t):
    return p.slow_queries(t.diagnostics, AS_OF, LOOKBACK)


@query(
    "audit_events",
    """
    SELECT time_generated, resource, event_class_s AS event_class,
           event_subclass_s AS event_subclass, user_s AS user, ip_s AS client_ip,
           db_s AS database, error_code_d AS error_code, is_aad_auth_s AS is_directory_auth,
           sql_text_s AS statement
    FROM audit_log ORDER BY time_generated DESC, resource, user, statement LIMIT 500
    """,
)
def _audit_events(t):
    return p.audit_events(t.diagnostics, AS_OF, LOOKBACK)


@query(
    "failed_logins",
    """
    SELECT client_ip, error_code, failures, last_seen,
           array_to_string(list_slice(users, 1, 10), ',') AS users
    FROM (SELECT ip_s AS client_ip, error_code_d AS error_code, count(*) AS failures,
                 max(time_generated) AS last_seen, list_sort(list(DISTINCT user_s)) AS users
          FROM audit_log WHERE event_class_s = 'connection_log' AND error_code_d <> 0
          GROUP BY ALL)
    """,
)
def _failed_logins(t):
    return p.failed_logins(t.diagnostics, AS_OF, LOOKBACK).withColumn(
        "users", F.array_join("users", ",")
    )


def _bins(names, aggregates: str, width: str = "5 MINUTES", by: str = "metric_name, resource"):
    listed = ", ".join(f"'{n}'" for n in names)
    return (
        f"SELECT time_bucket(INTERVAL {width}, time_generated) AS time_generated, {by}, "
        f"{aggregates} FROM platform_metrics WHERE metric_name IN ({listed}) GROUP BY ALL"
    )


@query(
    "connection_metrics",
    _bins(p.CONNECTION_METRICS,
          f"{r('avg(average)', 'avg')}, {r('max(maximum)', 'max')}, {r('sum(total)', 'total')}"),
)
def _connection_metrics(t):
    return p.connection_metrics(t.platform_metrics, AS_OF, LOOKBACK)


def _pivot(**columns: str) -> str:
    sums = ", ".join(
        f"sum(total) FILTER (WHERE metric_name = '{m}') AS {c}" for c, m in columns.items()
    )
    return (
        f"(SELECT time_bucket(INTERVAL 5 MINUTES, time_generated) AS time_generated, {sums} "
        "FROM platform_metrics GROUP BY ALL)"
    )


@query(
    "aborted_ratio",
    f"""
    SELECT time_generated, {r('a', 'aborted_connections')}, {r('t', 'total_connections')},
           {r('CASE WHEN t > 0 THEN a / t ELSE 0 END', 'aborted_ratio')}
    FROM {_pivot(a='aborted_connections', t='total_connections')}
    """,
)
def _aborted_ratio(t):
    return p.aborted_ratio(t.platform_metrics, AS_OF, LOOKBACK)


@query(
    "platform_hit_ratio",
    f"""
    SELECT time_generated, {r('1 - a / t', 'hit_ratio')}
    FROM {_pivot(a='Innodb_buffer_pool_reads', t='Innodb_buffer_pool_read_requests')} WHERE t > 0
    """,
)
def _platform_hit_ratio(t):
    return p.platform_hit_ratio(t.platform_metrics, AS_OF, LOOKBACK)


@query(
    "cpu_memory",
    _bins(p.CPU_MEMORY_METRICS,
          f"{half_up('avg(average)', 2)} AS avg, {half_up('max(maximum)', 2)} AS max"),
)
def _cpu_memory(t):
    return p.cpu_memory(t.platform_metrics, AS_OF, LOOKBACK)


@query(
    "saturation",
    f"""
    SELECT metric_name, resource, {half_up('avg(average)', 1)} AS avg,
           {half_up('quantile_cont(maximum, 0.95)', 1)} AS p95,
           {half_up('max(maximum)', 1)} AS peak
    FROM platform_metrics WHERE metric_name IN
         ({", ".join(f"'{m}'" for m in p.SATURATION_METRICS)}) GROUP BY ALL
    """,
)
def _saturation(t):
    return p.saturation(t.platform_metrics, AS_OF, LOOKBACK)


@query(
    "storage_metrics",
    _bins(p.STORAGE_METRICS, f"{r('avg(average)', 'avg')}, {r('max(maximum)', 'max')}"),
)
def _storage_metrics(t):
    return p.storage_metrics(t.platform_metrics, AS_OF, LOOKBACK)


@query(
    "storage_headroom",
    _bins(["storage_percent"], r("max(maximum)", "max_percent"), "1 HOUR", "resource"),
)
def _storage_headroom(t):
    return p.storage_headroom(t.platform_metrics, AS_OF, LOOKBACK)


_PROVIDER = "resource_provider = 'MICROSOFT.DBFORMYSQL'"


@query(
    "platform_events",
    f"""
    SELECT time_generated, operation_name, activity_status, activity_substatus, caller, caller_ip,
           resource_group, resource_id AS resource, correlation_id
    FROM activity WHERE {_PROVIDER} ORDER BY time_generated DESC, correlation_id LIMIT 200
    """,
)
def _platform_events(t):
    return p.platform_events(t.activity, AS_OF, LOOKBACK)


def _term(terms: str) -> str:
    return f"regexp_matches(operation_name, '(?i)(^|[^a-z0-9])({terms})([^a-z0-9]|$)')"


@query(
    "restarts",
    f"SELECT time_generated, operation_name, caller, resource_id FROM activity WHERE {_PROVIDER} "
    f"AND {_term('restart|failover|start|stop')} AND activity_status = 'Success'",
)
def _restarts(t):
    return p.restarts(t.activity, AS_OF, LOOKBACK)


@query(
    "config_changes",
    "SELECT time_generated, operation_name, activity_status, caller, resource_id FROM activity "
    f"WHERE {_PROVIDER} AND {_term('configurations')}",
)
def _config_changes(t):
    return p.config_changes(t.activity, AS_OF, LOOKBACK)


# --- alerts ---------------------------------------------------------------------------------


def _alert_sql(rules) -> str:
    parts = []
    for rule in rules:
        value = {
            "Average": "avg(average)", "Total": "sum(total)", "Maximum": "max(maximum)",
        }[rule.aggregation]
        size, step = rule.window_minutes, rule.every_minutes
        parts.append(f"""
            SELECT '{rule.name}' AS rule, {rule.severity} AS severity, resource, window_start,
                   window_start + INTERVAL {size} MINUTE AS window_end,
                   {r(value, 'value')}, {float(rule.threshold)}::DOUBLE AS threshold
            FROM (SELECT *, time_bucket(INTERVAL {step} MINUTE, time_generated)
                            - i * INTERVAL {step} MINUTE AS window_start
                  FROM (SELECT *, unnest(range({size // step})) AS i FROM platform_metrics
                        WHERE metric_name = '{rule.metric}'))
            GROUP BY resource, window_start HAVING {value} > {rule.threshold}
        """)
    return " UNION ALL ".join(parts)


@query("metric_alerts", _alert_sql(alerts.RULES))
def _metric_alerts(t):
    return alerts.metric_alerts(t.platform_metrics)


@query("replication_lag_alert", _alert_sql([alerts.REPLICATION_RULE]))
def _replication_lag_alert(t):
    return alerts.replication_lag_alert(t.platform_metrics)


@query(
    "error_alert",
    "SELECT ts, run_id, host, error_code, subsystem, message FROM log_events WHERE level = 'Error'",
)
def _error_alert(t):
    return alerts.error_alert(t.log_events)


# --- audits ---------------------------------------------------------------------------------


@query(
    "audit_heartbeats",
    """
    SELECT run_id, coalesce(heartbeats, 0) AS heartbeats, cycles,
           coalesce(heartbeats, 0) >= cycles AS passed
    FROM (SELECT run_id, count(DISTINCT observed_at) AS cycles FROM cycles GROUP BY run_id)
    LEFT JOIN (SELECT run_id, count(*) AS heartbeats FROM metrics
               WHERE metric = 'collector_heartbeat' GROUP BY run_id) USING (run_id)
    """,
)
def _audit_heartbeats(t):
    cycles = t.cycles.select("run_id", F.col("observed_at").alias("cycle_ts"))
    return audits.audit_heartbeats(t.metrics, cycles)


@query(
    "audit_tags",
    """
    SELECT count(*) AS rows, count(*) FILTER (WHERE k % 10 IN (0, 1)) AS untagged,
           count(*) FILTER (WHERE k % 10 IN (0, 1)) = 0 AS passed FROM ev
    """,
)
def _audit_tags(t):
    rows = t.events.select(
        F.when(F.col("k") % 10 != 0, F.col("run_id")).alias("run_id"),
        F.when(F.col("k") % 10 == 1, "").otherwise(F.col("tier")).alias("tier"),
    )
    return audits.audit_tags(rows)


@query(
    "audit_timestamps",
    """
    SELECT count(*) AS rows, count(*) FILTER (WHERE k % 10 IN (0, 1)) AS without_z,
           count(*) FILTER (WHERE k % 10 IN (0, 1)) = 0 AS passed FROM ev
    """,
)
def _audit_timestamps(t):
    text = utc_iso(F.col("ts"))
    rows = t.events.select(
        F.when(F.col("k") % 10 == 0, F.regexp_replace(text, "Z$", ""))
        .when(F.col("k") % 10 != 1, text).alias("ts")
    )
    return audits.audit_timestamps(rows)


@query("audit_sources", "SELECT DISTINCT source FROM metrics")
def _audit_sources(t):
    return audits.audit_sources(t.metrics)


@query(
    "audit_legacy_presence",
    "SELECT run_id, count(*) AS rows, count(DISTINCT metric) AS metrics, max(ts) AS last_ts "
    "FROM metrics GROUP BY run_id",
)
def _audit_legacy_presence(t):
    return audits.audit_legacy_presence(t.metrics)


@query(
    "audit_contract_presence",
    """
    SELECT run_id, count(*) AS rows, count(DISTINCT measurement) AS measurements,
           count(DISTINCT target_id) AS targets, min(contract_version) AS min_version,
           max(contract_version) AS max_version,
           min(contract_version) = 2 AND max(contract_version) = 2 AS passed
    FROM points GROUP BY run_id
    """,
)
def _audit_contract_presence(t):
    return audits.audit_contract_presence(t.points)


@query(
    "audit_categories",
    """
    SELECT 'MySqlSlowLogs' AS category, count(*) AS rows, true AS passed FROM slow_log
    UNION ALL SELECT 'MySqlAuditLogs', count(*), true FROM audit_log
    """,
)
def _audit_categories(t):
    return audits.audit_categories(t.diagnostics)


# A late enough day that part of the month is past its lifecycle.
_LATER = AS_OF.replace(month=4, day=10)
_CUT = f"TIMESTAMP '{_LATER}' - INTERVAL 90 DAY"


def _lifecycle_frames(t):
    from tidegauge.operators import rollups

    return {
        "points": t.points, "series": t.series, "metrics": t.metrics, "events": t.log_events,
        "metrics_1m": rollups.metrics_rollup(t.metrics),
        "events_1m": rollups.events_rollup(t.log_events),
    }


_GROUPED = {
    "metrics_1m": "(SELECT DISTINCT time_bucket(INTERVAL 1 MINUTE, ts) AS ts, run_id, host, tier, "
                  "metric FROM metrics)",
    "events_1m": "(SELECT DISTINCT time_bucket(INTERVAL 1 MINUTE, ts) AS ts, run_id, host, tier, "
                 "level, subsystem FROM log_events)",
    "points": "points", "series": "series", "metrics": "metrics", "events": "log_events",
}


@query(
    "audit_retention",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, min(ts) AS oldest, "
        f"count(*) FILTER (WHERE ts < {_CUT}) AS expired, "
        f"count(*) FILTER (WHERE ts < {_CUT}) = 0 AS passed FROM {source}"
        for name, source in _GROUPED.items()
    ),
)
def _audit_retention(t):
    return audits.audit_retention(_lifecycle_frames(t), _LATER)


@query(
    "retention_filter",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS kept, min(ts) AS oldest FROM {source} "
        f"WHERE ts >= {_CUT}"
        for name, source in _GROUPED.items()
    ),
)
def _retention_filter(t):
    parts = [
        audits.retention_filter(frame, _LATER)
        .agg(F.count(F.lit(1)).alias("kept"), F.min("ts").alias("oldest"))
        .select(F.lit(name).alias("table_name"), "kept", "oldest")
        for name, frame in _lifecycle_frames(t).items()
    ]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part)
    return joined


def _latest(name: str) -> str:
    return f"arg_max(variable_value, observed_at) FILTER (WHERE variable_name = '{name}')"


@query(
    "server_compliance",
    f"""
    SELECT *, coalesce(version LIKE '8.4%', false) AS version_ok,
           redo_capacity IS NOT NULL AS redo_ok,
           coalesce(upper(secure_transport) = 'ON', false) AS tls_ok
    FROM (SELECT target_id, {_latest('version')} AS version,
                 {_latest('innodb_redo_log_capacity')} AS redo_capacity,
                 {_latest('require_secure_transport')} AS secure_transport
          FROM variables GROUP BY target_id)
    """,
)
def _server_compliance(t):
    return audits.server_compliance(t.snapshot("variables"))


@query(
    "freshness_probe",
    f"""
    SELECT legacy, packed, series, legacy > 0 AND packed > 0 AND series >= 1 AS visible
    FROM (SELECT (SELECT count(*) FROM metrics WHERE metric = 'collector_heartbeat') AS legacy,
                 (SELECT count(*) FROM points WHERE target_id = 'target-1'
                  AND ts >= TIMESTAMP '{START}') AS packed,
                 (SELECT count(*) FROM series WHERE target_id = 'target-1'
                  AND ts >= TIMESTAMP '{START}') AS series)
    """,
)
def _freshness_probe(t):
    return audits.freshness_probe(
        t.metrics, t.points, t.series, "collector_heartbeat", "target-1", START
    )


@query(
    "cardinality_audit",
    """
    SELECT target_id, measurement, max(series) AS series,
           CASE measurement WHEN 'mysql.file_io' THEN 300 ELSE 50 END AS bound,
           max(series) <= CASE measurement WHEN 'mysql.file_io' THEN 300 ELSE 50 END AS passed
    FROM (SELECT target_id, measurement, ts, count(DISTINCT series_key) AS series FROM points
          WHERE measurement IN ('mysql.file_io', 'mysql.statement_digest') GROUP BY ALL)
    GROUP BY target_id, measurement
    """,
)
def _cardinality_audit(t):
    return audits.cardinality_audit(t.points)

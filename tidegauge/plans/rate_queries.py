"""Rates, rollups and health."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import functions as F

from tidegauge.operators import health, rates, rollups
from tidegauge.operators.platform import restarts
from tidegauge.plans.fixtures import AS_OF, END, LOOKBACK, RUN, START
from tidegauge.plans.registry import RANGE, field_is, query, r, rate_tables

RUNS = ["run-base", "run-cand"]
DAYS = timedelta(days=90)
NOW = f"TIMESTAMP '{AS_OF}'"

_LEGACY = {
    "legacy": f"""
        SELECT *, value - prev_value AS delta,
               epoch_us(ts) // 1000000 - epoch_us(prev_ts) // 1000000 AS seconds
        FROM (SELECT *, lag(ts) OVER w AS prev_ts, lag(value) OVER w AS prev_value
              FROM metrics WHERE metric = 'Queries' AND run_id = '{RUN}' AND {RANGE}
              WINDOW w AS (PARTITION BY host ORDER BY ts, value))
    """
}


@query(
    "counter_rate",
    f"SELECT ts, host, tier, metric, {r('delta / seconds', 'rate')} FROM legacy "
    "WHERE seconds > 0 AND delta >= 0",
    _LEGACY,
)
def _counter_rate(t):
    return rates.counter_rate(t.metrics, "Queries", RUN, START, END)


_RATE_SELECT = (
    "SELECT ts, run_id, target_id, host, tier, measurement, field, series_key, tag_event AS event, "
    f"tag_mode AS mode, {r('delta', 'delta')}, {r('seconds', 'seconds')}, {r('rate', 'rate')} "
    "FROM rates"
)


def _with_tags(frame):
    return frame.withColumn("event", F.coalesce(F.col("tags")["event"], F.lit(""))).withColumn(
        "mode", F.coalesce(F.col("tags")["mode"], F.lit(""))
    ).drop("tags")


@query(
    "metric_series_rate", _RATE_SELECT,
    rate_tables(field_is("mysql.file_io", "wait_ms_total") + f" AND run_id = '{RUN}'"),
)
def _metric_series_rate(t):
    return _with_tags(
        rates.metric_series_rate(t.series, "mysql.file_io", "wait_ms_total", RUN, START, END)
    )


@query(
    "rate_ties",
    """
    SELECT ts, run_id, host, round(delta / seconds, 6) + 0e0 AS rate FROM (
        SELECT *, value - lag(value) OVER w AS delta,
               epoch_us(ts) // 1000000 - epoch_us(lag(ts) OVER w) // 1000000 AS seconds
        FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 SECOND * (event_id % 2) AS ts,
                     run_id, host, CAST(event_id % 977 AS DOUBLE) AS value FROM ev)
        WINDOW w AS (PARTITION BY run_id, host ORDER BY ts, value))
    WHERE seconds > 0 AND delta >= 0
    """,
)
def _rate_ties(t):
    """Many values at one instant, on both sides of the borders of hour slices."""
    ties = t.events.selectExpr(
        "date_trunc('hour', ts) - make_interval(0, 0, 0, 0, 0, 0, event_id % 2) AS ts", "run_id",
        "host", "'tier' AS tier", "'m' AS metric", "CAST(event_id % 977 AS DOUBLE) AS value",
    )
    runs = [r["run_id"] for r in ties.select("run_id").distinct().collect()]
    rated = [rates.counter_rate(ties, "m", run).select("ts", F.lit(run).alias("run_id"), "host", "rate")
             for run in sorted(runs)]
    return reduce(lambda a, b: a.unionByName(b), rated)


@query(
    "multi_rate", _RATE_SELECT,
    rate_tables(f"({field_is('mysql.file_io', 'operations_total', 'bytes_total')} "
                f"OR {field_is('mysql.global_status', 'Queries')})"),
)
def _multi_rate(t):
    fields = {
        "mysql.file_io": ["operations_total", "bytes_total"], "mysql.global_status": ["Queries"],
    }
    frame = rates.multi_rate(t.series, fields, RUNS, START, END)
    return _with_tags(frame.drop("_slice"))


_RESETS = rate_tables(field_is("mysql.global_status", "Queries", "Innodb_rows_read"))


@query(
    "counter_resets",
    "SELECT ts, run_id, target_id, measurement, field, series_key, host, "
    f"{r('value', 'value')}, prev_ts, {r('prev_value', 'prev_value')} FROM paired WHERE delta < 0",
    _RESETS,
)
def _counter_resets(t):
    fields = {"mysql.global_status": ["Queries", "Innodb_rows_read"]}
    return rates.counter_resets(t.series, fields, RUNS, START, END)


@query(
    "explained_resets",
    """
    SELECT a.ts AS ts, a.run_id AS run_id, a.target_id AS target_id, a.field AS field,
           b.ts AS restart_ts, b.operation AS operation,
           coalesce(epoch_us(a.ts) // 1000000 - epoch_us(b.ts) // 1000000 <= 3600, false)
               AS explained
    FROM resets a ASOF LEFT JOIN marks b ON a.host = b.host AND a.ts >= b.ts
    """,
    {
        **_RESETS,
        "resets": "SELECT * FROM paired WHERE delta < 0",
        "marks": """
            SELECT host, time_generated AS ts, max(operation_name) AS operation FROM (
                SELECT *, concat(resource_id, '.db') AS host FROM activity
                WHERE resource_provider = 'MICROSOFT.DBFORMYSQL' AND activity_status = 'Success'
                  AND regexp_matches(operation_name,
                      '(?i)(^|[^a-z0-9])(restart|failover|start|stop)([^a-z0-9]|$)'))
            GROUP BY host, time_generated
        """,
    },
)
def _explained_resets(t):
    resets = rates.counter_resets(
        t.series, {"mysql.global_status": ["Queries", "Innodb_rows_read"]}, RUNS, START, END
    )
    marks = (
        restarts(t.activity, AS_OF, LOOKBACK)
        .groupBy(F.concat("resource_id", F.lit(".db")).alias("host"),
                 F.col("time_generated").alias("ts"))
        .agg(F.max("operation_name").alias("operation"))
    )
    return rates.explain_resets(resets, marks, 3600).select(
        "ts", "run_id", "target_id", "field", "restart_ts", "operation", "explained"
    )


# --- rollups --------------------------------------------------------------------------------

_ROLLUP = f"""
    SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS ts, run_id, host, tier, metric,
           {r('avg(value)', 'avg')}, {r('max(value)', 'max')}, {r('min(value)', 'min')},
           count(*) AS samples
    FROM metrics GROUP BY ALL
"""


@query("metrics_1m", _ROLLUP)
def _metrics_1m(t):
    return rollups.metrics_rollup(t.metrics)


@query(
    "metrics_5m",
    _ROLLUP.replace("1 MINUTE", "5 MINUTES"),
)
def _metrics_5m(t):
    return rollups.metrics_rollup(t.metrics, 300)


@query("metrics_1m_merged", _ROLLUP)
def _metrics_1m_merged(t):
    return rollups.merge_partials(rollups.metrics_partials(t.metrics))


@query(
    "events_1m",
    "SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS ts, run_id, host, tier, level, subsystem, "
    "count(*) AS events FROM log_events GROUP BY ALL",
)
def _events_1m(t):
    return rollups.events_rollup(t.log_events)


# --- health ---------------------------------------------------------------------------------

_HEALTH = {
    "health": f"""
        SELECT target_id, host, run_id, last_beat,
               epoch_us({NOW}) // 1000000 - epoch_us(last_beat) // 1000000
                   AS seconds_since_last_beat,
               CASE WHEN epoch_us({NOW}) // 1000000 - epoch_us(last_beat) // 1000000 > 60
                    THEN 'DOWN' ELSE 'OK' END AS status
        FROM (SELECT target_id, host, run_id, max(ts) AS last_beat
              FROM (SELECT ts, target_id, host, run_id FROM beats
                    UNION ALL
                    SELECT ts, host, host, run_id FROM metrics m
                    WHERE metric = 'collector_heartbeat' AND ts > {NOW} - INTERVAL 90 DAY
                      AND NOT EXISTS (SELECT 1 FROM beats b
                                      WHERE b.host = m.host AND b.run_id = m.run_id))
              GROUP BY ALL)
    """,
    "beats": f"""
        SELECT ts, target_id, host, run_id FROM series
        WHERE measurement = 'collector.health' AND field = 'heartbeat'
          AND ts > {NOW} - INTERVAL 90 DAY
    """,
}


@query("collector_health", "SELECT * FROM health", _HEALTH)
def _collector_health(t):
    return health.collector_health(t.series, t.metrics, AS_OF, DAYS)


@query(
    "heartbeat_panel",
    "SELECT * FROM health WHERE run_id IN ('run-base', 'run-cand') "
    "AND target_id <> 'verify-probe'",
    _HEALTH,
)
def _heartbeat_panel(t):
    return health.heartbeat_panel(t.series, t.metrics, RUNS, AS_OF)


# At this time some hosts are silent and some are not.
_ALERT_TIME = AS_OF


@query(
    "heartbeat_alert",
    f"""
    SELECT host, max(ts) AS last_seen FROM metrics
    WHERE metric = 'collector_heartbeat' AND ts > TIMESTAMP '{_ALERT_TIME}' - INTERVAL 5 MINUTE
    GROUP BY host HAVING max(ts) < TIMESTAMP '{_ALERT_TIME}' - INTERVAL 60 SECOND
    """,
)
def _heartbeat_alert(t):
    return health.heartbeat_alert(t.metrics, _ALERT_TIME)


@query(
    "distinct_fields",
    f"SELECT target_id, measurement, count(DISTINCT field) AS fields FROM series "
    f"WHERE {RANGE} GROUP BY ALL",
)
def _distinct_fields(t):
    return health.distinct_fields(t.series, RUNS, START, END)


@query(
    "rows_ingested",
    f"SELECT target_id, count(*) AS rows FROM points WHERE {RANGE} GROUP BY ALL",
)
def _rows_ingested(t):
    return health.rows_ingested(t.points, RUNS, START, END)


@query(
    "arrival_rate",
    f"""
    SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS ts, concat(target_id, ' / ', measurement) AS series,
           count(*) AS rows
    FROM points WHERE {RANGE} GROUP BY ALL
    """,
)
def _arrival_rate(t):
    return health.arrival_rate(t.points, RUNS, START, END)


@query(
    "cycle_duration",
    f"SELECT ts, target_id, {r('value', 'value')} FROM series "
    f"WHERE {field_is('collector.health', 'cycle_duration_ms')} AND {RANGE}",
)
def _cycle_duration(t):
    return health.cycle_duration(t.series, RUNS, START, END)


@query(
    "ingestion_lag",
    f"""
    SELECT run_id, target_id, host, tier, max(ts) AS newest, count(*) AS rows,
           count(DISTINCT measurement) AS measurements,
           epoch_us({NOW}) // 1000000 - epoch_us(max(ts)) // 1000000 AS age_seconds
    FROM points GROUP BY run_id, target_id, host, tier
    """,
)
def _ingestion_lag(t):
    return health.ingestion_lag(t.points, AS_OF)

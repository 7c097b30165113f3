"""Dashboard panels."""

from __future__ import annotations

from tidegauge.operators import panels as p
from tidegauge.plans.fixtures import AS_OF, END, RUN, START, TARGETS
from tidegauge.plans.rate_queries import _HEALTH
from tidegauge.plans.registry import RANGE, field_is, query, r, rate_tables

_SCOPE = f"run_id = '{RUN}'"
_ARGS = (RUN, TARGETS, START, END)


def _rates(measurement: str, *fields: str) -> dict[str, str]:
    return rate_tables(f"{field_is(measurement, *fields)} AND {_SCOPE}")


@query(
    "overview_heartbeat",
    f"""
    SELECT target_id, seconds_since_last_beat,
           CASE WHEN seconds_since_last_beat >= 120 THEN 'critical'
                WHEN seconds_since_last_beat >= 60 THEN 'warning' ELSE 'ok' END AS band
    FROM health WHERE {_SCOPE} AND target_id IN ('target-0', 'target-1', 'target-2')
    """,
    _HEALTH,
)
def _overview_heartbeat(t):
    return p.overview_heartbeat(t.series, t.metrics, RUN, TARGETS, AS_OF)


for _name, _field, _column, _build in (
    ("latest_threads_connected", "Threads_connected", "connected", p.latest_threads_connected),
    ("latest_slow_queries", "Slow_queries", "slow_queries", p.latest_slow_queries),
):

    @query(
        _name,
        f"SELECT target_id, {r('arg_max(value, ts)', _column)} FROM series "
        f"WHERE {field_is('mysql.global_status', _field)} AND {_SCOPE} AND {RANGE} "
        "GROUP BY target_id",
    )
    def _latest(t, build=_build):
        return build(t.series, *_ARGS)


@query(
    "buffer_pool_hit_ratio",
    f"""
    SELECT target_id, {r('hit', 'hit_ratio')},
           CASE WHEN hit >= 0.99 THEN 'ok' WHEN hit >= 0.95 THEN 'warning' ELSE 'critical' END
               AS band
    FROM (SELECT target_id, arg_max(1 - a.rate / b.rate, ts) AS hit
          FROM (SELECT * FROM rates WHERE field = 'Innodb_buffer_pool_reads') a
          JOIN (SELECT * FROM rates WHERE field = 'Innodb_buffer_pool_read_requests') b
          USING (ts, target_id) WHERE b.rate > 0 GROUP BY target_id)
    """,
    _rates("mysql.global_status", "Innodb_buffer_pool_reads", "Innodb_buffer_pool_read_requests"),
)
def _buffer_pool_hit_ratio(t):
    return p.buffer_pool_hit_ratio(t.series, *_ARGS)


for _name, _field, _column, _build in (
    ("qps_series", "Queries", "qps", p.qps_series),
    ("redo_waits", "Innodb_log_waits", "waits_per_second", p.redo_waits),
):

    @query(
        _name, f"SELECT ts, target_id, {r('rate', _column)} FROM rates",
        _rates("mysql.global_status", _field),
    )
    def _status_rate(t, build=_build):
        return build(t.series, *_ARGS)


@query(
    "threads_series",
    f"""
    SELECT ts, concat(target_id, ' / ', field) AS series, {r('value', 'value')} FROM series
    WHERE {field_is('mysql.global_status', 'Threads_connected', 'Threads_running',
                    'Threads_cached', 'Max_used_connections')} AND {_SCOPE} AND {RANGE}
    """,
)
def _threads_series(t):
    return p.threads_series(t.series, *_ARGS)


for _name, _fields, _build in (
    ("row_operations",
     ("Innodb_rows_read", "Innodb_rows_inserted", "Innodb_rows_updated", "Innodb_rows_deleted"),
     p.row_operations),
    ("connection_errors", ("Aborted_connects", "Aborted_clients"), p.connection_errors),
):

    @query(
        _name,
        f"SELECT ts, concat(target_id, ' / ', field) AS series, {r('rate', 'rate')} FROM rates",
        _rates("mysql.global_status", *_fields),
    )
    def _labelled(t, build=_build):
        return build(t.series, *_ARGS)


@query(
    "recent_errors",
    f"""
    SELECT ts, target_id, level, error_code, subsystem, message
    FROM (SELECT ts, host, level, error_code, subsystem, message FROM log_events
          WHERE {_SCOPE} AND {RANGE})
    JOIN (SELECT DISTINCT target_id, host FROM points WHERE {_SCOPE}) USING (host)
    ORDER BY ts DESC, target_id, error_code, message LIMIT 200
    """,
)
def _recent_errors(t):
    return p.recent_errors(t.points, t.log_events, *_ARGS)


for _name, _field, _column, _build in (
    ("worst_p95", "latency_p95_ms", "worst_p95_ms", p.worst_p95),
    ("worst_p99", "latency_p99_ms", "worst_p99_ms", p.worst_p99),
):

    @query(
        _name,
        f"""
        SELECT target_id, {r('max(value)', _column)}
        FROM (SELECT *, max(ts) OVER (PARTITION BY target_id) AS newest FROM series
              WHERE {field_is('mysql.statement_digest', _field)} AND {_SCOPE} AND {RANGE})
        WHERE ts = newest GROUP BY target_id
        """,
    )
    def _worst(t, build=_build):
        return build(t.series, *_ARGS)


for _name, _field, _column, _build in (
    ("statement_error_rate", "errors_total", "errors_per_second", p.statement_error_rate),
    ("no_index_rate", "no_index_used_total", "no_index_per_second", p.no_index_rate),
):

    @query(
        _name,
        f"SELECT target_id, {r('arg_max(total, ts)', _column)} FROM "
        "(SELECT target_id, ts, sum(rate) AS total FROM rates GROUP BY target_id, ts) "
        "GROUP BY target_id",
        _rates("mysql.statement_digest", _field),
    )
    def _digest_rate(t, build=_build):
        return build(t.series, *_ARGS)


def _max_of(field: str, name: str) -> str:
    return r(f"max(value) FILTER (WHERE field = '{field}')", name)


@query(
    "top_digests",
    f"""
    SELECT target_id, tag_schema AS schema, tag_digest AS digest,
           {_max_of('executions_total', 'executions')}, {_max_of('latency_p95_ms', 'p95_ms')},
           {_max_of('latency_p99_ms', 'p99_ms')}, {_max_of('errors_total', 'errors')},
           {_max_of('rows_examined_total', 'rows_examined')}
    FROM (SELECT *, max(ts) OVER (PARTITION BY target_id) AS newest FROM series
          WHERE measurement = 'mysql.statement_digest' AND {_SCOPE} AND {RANGE})
    WHERE ts = newest GROUP BY ALL ORDER BY p99_ms DESC, target_id, schema, digest LIMIT 100
    """,
)
def _top_digests(t):
    return p.top_digests(t.series, *_ARGS)


@query(
    "tail_series",
    f"""
    SELECT ts, concat(target_id, ' / ', field) AS series, {r('max(value)', 'latency_ms')}
    FROM series WHERE {field_is('mysql.statement_digest', 'latency_p95_ms', 'latency_p99_ms')}
      AND {_SCOPE} AND {RANGE} GROUP BY ts, target_id, field
    """,
)
def _tail_series(t):
    return p.tail_series(t.series, *_ARGS)


@query(
    "tmp_and_no_index",
    f"SELECT ts, concat(target_id, ' / ', field) AS series, {r('sum(rate)', 'rate')} "
    "FROM rates GROUP BY ts, target_id, field",
    _rates("mysql.statement_digest", "tmp_disk_tables_total", "no_index_used_total"),
)
def _tmp_and_no_index(t):
    return p.tmp_and_no_index(t.series, *_ARGS)


for _name, _mode, _build in (
    ("read_iops", "read", p.read_iops), ("write_iops", "write", p.write_iops),
):

    @query(
        _name,
        f"SELECT ts, target_id, {r('sum(rate)', 'iops')} FROM rates "
        f"WHERE tag_mode = '{_mode}' GROUP BY ts, target_id",
        _rates("mysql.file_io", "operations_total"),
    )
    def _iops(t, build=_build):
        return build(t.series, *_ARGS)


@query(
    "file_throughput",
    f"SELECT ts, concat(target_id, ' / ', tag_mode) AS series, {r('sum(rate)', 'bytes_per_second')} "
    "FROM rates WHERE tag_mode IN ('read', 'write') GROUP BY ts, target_id, tag_mode",
    _rates("mysql.file_io", "bytes_total"),
)
def _file_throughput(t):
    return p.file_throughput(t.series, *_ARGS)


_OPS_WAITS = _rates("mysql.file_io", "operations_total", "wait_ms_total")


@query(
    "file_latency",
    f"""
    SELECT ts, concat(target_id, ' / ', mode) AS series,
           {r('sum(wait) / sum(ops)', 'latency_ms')}
    FROM (SELECT o.ts AS ts, o.target_id AS target_id, o.tag_mode AS mode, o.rate AS ops,
                 w.rate AS wait
          FROM (SELECT * FROM rates WHERE field = 'operations_total') o
          JOIN (SELECT * FROM rates WHERE field = 'wait_ms_total') w
          USING (ts, target_id, series_key) WHERE o.tag_mode IN ('read', 'write'))
    GROUP BY ts, target_id, mode HAVING sum(ops) > 0
    """,
    _OPS_WAITS,
)
def _file_latency(t):
    return p.file_latency(t.series, *_ARGS)


@query(
    "file_classes",
    f"""
    SELECT target_id, event, mode, {r('round(iops, 2)', 'iops')},
           {r('round(CASE WHEN operations > 0 THEN wait_ms / operations ELSE 0 END, 3)',
              'avg_latency_ms')},
           {r('operations', 'operations')}
    FROM (SELECT target_id, series_key, tag_event AS event, tag_mode AS mode, avg(rate) AS iops,
                 sum(delta) AS operations
          FROM rates WHERE field = 'operations_total' GROUP BY ALL) o
    JOIN (SELECT target_id, series_key, sum(delta) AS wait_ms FROM rates
          WHERE field = 'wait_ms_total' GROUP BY ALL) w USING (target_id, series_key)
    ORDER BY wait_ms DESC, target_id, series_key LIMIT 100
    """,
    _OPS_WAITS,
)
def _file_classes(t):
    return p.file_classes(t.series, *_ARGS)


@query(
    "run_list",
    "SELECT run_id FROM points WHERE run_id <> 'verify-probe' GROUP BY run_id ORDER BY max(ts) DESC",
)
def _run_list(t):
    return p.run_list(t.points)


@query(
    "target_list",
    f"SELECT DISTINCT target_id FROM points WHERE {_SCOPE} AND target_id <> 'verify-probe'",
)
def _target_list(t):
    return p.target_list(t.points, RUN)

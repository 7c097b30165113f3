"""The telemetry tables, derived from the given test tables.

Each frame below has the layout of a stored table and stands for it in the registered queries. All
derivations are projections of whole tables (snapshots also count and sum), so a query's own
shuffles are all there are. Counters grow with the seconds of the week, hence fall at every
week's start, and a little jitter makes some of them fall in between.

Formulas are text that Spark and the checking engine read alike.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidegauge.catalog import CATALOG, STATUS_NAMES
from tidegauge.operators.audits import CONTRACT_VERSION
from tidegauge.operators.benchmark import RunTarget
from tidegauge.session import prepare

AS_OF = datetime(2024, 1, 31)
START, END = datetime(2024, 1, 1), datetime(2024, 1, 30, 23, 0, 0)
WEEK = 604800
LOOKBACK = timedelta(days=12000)
TARGETS = ["target-0", "target-1", "target-2"]
RUN = "run-base"
BASELINE, CANDIDATE = RunTarget("run-base", "target-0"), RunTarget("run-cand", "target-1")

#: Counter and gauge formulas over ws (second of the week), k, cents, value and the copy number n.
STATUS_FORMULAS = {
    "Queries": "ws * 7 + k",
    "Innodb_rows_read": "ws * 11 + k",
    "Innodb_rows_inserted": "ws * 5 + k",
    "Innodb_rows_updated": "ws * 3 + k",
    "Innodb_rows_deleted": "ws + k",
    "Aborted_connects": "floor(ws / 60) + k % 3",
    "Aborted_clients": "floor(ws / 90) + k % 2",
    "Innodb_log_waits": "floor(ws / 30) + k % 5",
    "Innodb_buffer_pool_reads": "ws * 2 + k",
    "Innodb_buffer_pool_read_requests": "ws * 40 + k * 3",
    "Slow_queries": "floor(ws / 600)",
    "Threads_connected": "10 + k",
    "Threads_running": "k % 8",
    "Threads_cached": "k % 5",
    "Max_used_connections": "100 + k",
}
FILE_FORMULAS = {
    "operations_total": "ws * (2 + n) + k",
    "bytes_total": "ws * 4096 * (1 + n) + k * 512",
    "wait_ms_total": "(ws * (3 + n) * 10 + cents % 1000) / 100e0",
}
DIGEST_FORMULAS = {
    "executions_total": "ws * 3 + k",
    "rows_examined_total": "ws * 50 + k * 2",
    "errors_total": "floor(ws / 120) + k % 2",
    "tmp_disk_tables_total": "floor(ws / 240) + k % 3",
    "no_index_used_total": "floor(ws / 200) + k % 4",
    "latency_p95_ms": "value / 7e0 + n",
    "latency_p99_ms": "value / 3e0 + n",
}
HEALTH_FORMULAS = {
    "heartbeat": "1",
    "mysql_reachable": "CASE WHEN k % 10 = 0 THEN 0 ELSE 1 END",
    "cycle_duration_ms": "value",
}
#: Measurement: formulas, number of copies per event, tags, and key text.
SERIES = {
    "mysql.global_status": (STATUS_FORMULAS, 1, {}, "'status'"),
    "mysql.file_io": (
        FILE_FORMULAS, 3, {"event": "concat('class-', n)", "mode": "mode"},
        "concat('class-', n, '|', mode)",
    ),
    "mysql.statement_digest": (
        DIGEST_FORMULAS, 2,
        {
            "schema": "CASE (event_id + n) % 4 WHEN 0 THEN 'app' WHEN 1 THEN 'shop' "
                      "WHEN 2 THEN '(none)' ELSE '' END",
            "digest": "concat('d', (k + n) % 10)",
        },
        "concat((event_id + n) % 4, '|d', (k + n) % 10)",
    ),
    "collector.health": (HEALTH_FORMULAS, 1, {}, "'health'"),
}
LEGACY_FORMULAS = {
    "collector_heartbeat": ("collector", "1"),
    "collector_cycle_duration_ms": ("collector", "value"),
    "Queries": ("global_status", "ws * 7 + k"),
    "Threads_running": ("global_status", "k"),
}
PLATFORM_METRICS = (
    "active_connections", "total_connections", "aborted_connections", "Threads_running",
    "cpu_percent", "memory_percent", "cpu_credits_remaining", "cpu_credits_consumed",
    "io_consumption_percent", "storage_percent", "storage_used", "storage_limit",
    "data_storage_used", "binlog_storage_used", "Innodb_data_writes",
    "Innodb_buffer_pool_reads", "Innodb_buffer_pool_read_requests", "replication_lag",
)
OPERATIONS = {
    "1-URGENT": "MICROSOFT.DBFORMYSQL/FLEXIBLESERVERS/RESTART/ACTION",
    "2-HIGH": "MICROSOFT.DBFORMYSQL/FLEXIBLESERVERS/FAILOVER/ACTION",
    "3-MEDIUM": "MICROSOFT.DBFORMYSQL/FLEXIBLESERVERS/CONFIGURATIONS/WRITE",
    "4-NOT SPECIFIED": "MICROSOFT.DBFORMYSQL/FLEXIBLESERVERS/RESTARTED/ACTION",
    "5-LOW": "MICROSOFT.DBFORMYSQL/FLEXIBLESERVERS/START/ACTION",
}


def context_sql(number: str) -> str:
    """Context columns of a snapshot row."""
    return (
        f"'run-base' AS run_id, concat('target-', {number}) AS target_id, "
        f"concat('target-', {number}, '.db') AS host, 'premium-ssd-v1' AS tier, "
        "'' AS resource_id, 'collector-01' AS collector_id"
    )


def _summed(column: str, when: str, factor: str = "") -> str:
    return f"CAST(sum(CASE WHEN {when} THEN {column} END) AS BIGINT){factor}"


_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_MICRO = " * 1000000"
_MONTH = "date_trunc('month', l_shipdate) AS observed_at"

#: Server snapshots. {div} and {list} differ by engine.
SNAPSHOTS = {
    "files": f"""
        SELECT {context_sql('l_suppkey % 3')}, {_MONTH},
               concat('wait/io/file/class-', l_partkey % 150) AS event_name,
               count(*) - 1 AS count_star,
               {_summed(_CENTS, 'true', _MICRO)} AS sum_timer_wait,
               {_summed('1', "l_returnflag = 'R'")} AS count_read,
               {_summed('floor(l_quantity)', "l_returnflag = 'R'")} AS sum_number_of_bytes_read,
               {_summed(_CENTS, "l_returnflag = 'R'", _MICRO)} AS sum_timer_read,
               {_summed('1', "l_returnflag = 'A'")} AS count_write,
               {_summed('floor(l_quantity)', "l_returnflag = 'A'")} AS sum_number_of_bytes_write,
               {_summed(_CENTS, "l_returnflag = 'A'", _MICRO)} AS sum_timer_write,
               {_summed('1', "l_returnflag = 'N'")} AS count_misc,
               {_summed(_CENTS, "l_returnflag = 'N'", _MICRO)} AS sum_timer_misc
        FROM {{lineitem}} GROUP BY l_suppkey % 3, date_trunc('month', l_shipdate), l_partkey % 150
    """,
    "digests": f"""
        SELECT {context_sql('l_suppkey % 3')}, {_MONTH},
               CASE l_partkey % 5 WHEN 0 THEN 'app' WHEN 1 THEN 'shop' WHEN 2 THEN NULL
                    WHEN 3 THEN '' ELSE 'mysql' END AS schema_name,
               CASE WHEN l_partkey % 71 = 0 THEN NULL
                    ELSE concat('digest-', l_partkey % 71, '-abcdefghijkl') END AS digest,
               count(*) AS count_star,
               {_summed(_CENTS, 'true', _MICRO)} AS sum_timer_wait,
               {_summed('CAST(round(l_tax * 100) AS BIGINT)', 'true', _MICRO)} AS sum_lock_time,
               {_summed('floor(l_quantity)', 'true')} AS sum_rows_examined,
               {_summed('l_linenumber', 'true')} AS sum_rows_sent,
               {_summed('1', "l_returnflag = 'R'")} AS sum_errors,
               {_summed('1', "l_returnflag = 'A'")} AS sum_warnings,
               {_summed('1', "l_linestatus = 'O'")} AS sum_created_tmp_tables,
               {_summed('1', "l_linestatus = 'F'")} AS sum_created_tmp_disk_tables,
               {_summed('1', "l_linenumber = 1")} AS sum_no_index_used,
               max({_CENTS}){_MICRO} AS quantile_95,
               max({_CENTS}){_MICRO} * 2 AS quantile_99
        FROM {{lineitem}}
        GROUP BY l_suppkey % 3, date_trunc('month', l_shipdate), l_partkey % 5, l_partkey % 71
    """,
    "status": f"""
        SELECT {context_sql('(c_custkey {div} 95) % 3')},
               TIMESTAMP '2024-01-01 00:00:00' + (c_custkey {{div}} 285) * INTERVAL '1' MINUTE AS observed_at,
               CASE WHEN c_custkey % 95 < {len(STATUS_NAMES)}
                    THEN {{list}} ELSE concat('Other_', c_custkey % 95) END AS variable_name,
               CASE WHEN c_custkey % 13 = 0 THEN 'ON' WHEN c_custkey % 17 = 0 THEN '12f'
                    WHEN c_custkey % 19 = 0 THEN '1_500' WHEN c_custkey % 23 = 0 THEN NULL
                    ELSE concat(CAST(round(c_acctbal * 100) AS BIGINT), '.5') END
                    AS variable_value
        FROM {{customer}}
    """,
    "variables": f"""
        SELECT {context_sql('(c_custkey {div} 6) % 3')},
               TIMESTAMP '2024-01-01 00:00:00' + (c_custkey {{div}} 18) * INTERVAL '1' MINUTE AS observed_at,
               CASE c_custkey % 6 WHEN 0 THEN 'version' WHEN 1 THEN 'innodb_redo_log_capacity'
                    WHEN 2 THEN 'require_secure_transport' WHEN 3 THEN 'max_connections'
                    WHEN 4 THEN 'time_zone' ELSE 'long_query_time' END AS variable_name,
               CASE c_custkey % 6
                    WHEN 0 THEN concat(CASE WHEN c_nationkey < 12 THEN '8.0.' ELSE '8.4.' END,
                                       c_nationkey)
                    WHEN 1 THEN concat(c_custkey * 1024)
                    WHEN 2 THEN CASE WHEN c_nationkey < 8 THEN 'off' ELSE 'on' END
                    WHEN 3 THEN concat(c_custkey) WHEN 4 THEN 'SYSTEM'
                    ELSE concat(c_nationkey, '.25') END AS variable_value
        FROM {{customer}}
    """,
    "engine_metrics": f"""
        SELECT {context_sql('(p_partkey {div} 60) % 3')},
               TIMESTAMP '2024-01-01 00:00:00' + (p_partkey {{div}} 180) * INTERVAL '1' MINUTE AS observed_at,
               concat('metric_', p_partkey % 60) AS name, p_brand AS subsystem,
               CASE p_size % 4 WHEN 0 THEN 'counter' WHEN 1 THEN 'status_counter'
                    WHEN 2 THEN 'value' ELSE 'set_owner' END AS type,
               CASE WHEN p_size % 5 = 0 THEN 'disabled' ELSE 'enabled' END AS status,
               CASE WHEN p_size % 11 = 0 THEN NULL
                    ELSE CAST(round(p_retailprice * 100) AS BIGINT) END AS count
        FROM {{part}}
    """,
    "sessions": f"""
        SELECT {context_sql('o_custkey % 3')}, date_trunc('month', o_orderdate) AS observed_at,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS command,
               CASE WHEN o_orderpriority = '1-URGENT' THEN ''
                    WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderpriority END AS state,
               o_custkey % 1000 AS time
        FROM {{orders}}
    """,
    "tables": f"""
        SELECT {context_sql('p_partkey % 3')}, TIMESTAMP '2024-01-01 00:00:00' AS observed_at,
               CASE p_size % 6 WHEN 0 THEN 'app' WHEN 1 THEN 'shop' WHEN 2 THEN 'mysql'
                    WHEN 3 THEN 'sys' WHEN 4 THEN NULL ELSE 'games' END AS table_schema,
               concat('t', p_partkey) AS table_name,
               CASE WHEN p_size % 7 = 0 THEN NULL ELSE 'InnoDB' END AS engine,
               CASE WHEN p_size % 9 = 0 THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type,
               p_size * 100 AS table_rows,
               CAST(round(p_retailprice * 100) AS BIGINT) AS data_length,
               p_partkey * 10 AS index_length,
               CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size END AS data_free
        FROM {{part}}
    """,
    "object_io": f"""
        SELECT {context_sql('l_suppkey % 3')}, {_MONTH},
               CASE l_partkey % 4 WHEN 0 THEN 'app' WHEN 1 THEN 'shop' WHEN 2 THEN 'sys'
                    ELSE 'games' END AS object_schema,
               concat('t', l_partkey % 170) AS object_name,
               CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber < 5 THEN 'PRIMARY'
                    ELSE concat('ix', l_linenumber) END AS index_name,
               count(*) - 1 AS count_star,
               {_summed(_CENTS, 'true', _MICRO)} AS sum_timer_wait,
               {_summed('1', "l_returnflag = 'R'")} AS count_fetch,
               {_summed(_CENTS, "l_returnflag = 'R'", _MICRO)} AS sum_timer_fetch,
               {_summed('1', "l_returnflag = 'A'")} AS count_insert,
               {_summed(_CENTS, "l_returnflag = 'A'", _MICRO)} AS sum_timer_insert,
               {_summed('1', "l_linestatus = 'F'")} AS count_update,
               {_summed(_CENTS, "l_linestatus = 'F'", _MICRO)} AS sum_timer_update,
               {_summed('1', "l_linestatus = 'O'")} AS count_delete,
               {_summed(_CENTS, "l_linestatus = 'O'", _MICRO)} AS sum_timer_delete
        FROM {{lineitem}}
        GROUP BY l_suppkey % 3, date_trunc('month', l_shipdate), l_partkey % 4, l_partkey % 170,
                 CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber < 5 THEN 'PRIMARY'
                      ELSE concat('ix', l_linenumber) END
    """,
}


def snapshot_sql(name: str, div: str, names: str) -> str:
    """Text of a snapshot for one engine; the tables are left as {table}."""
    text = SNAPSHOTS[name]
    for key, value in {"div": div, "list": names}.items():
        text = text.replace("{" + key + "}", value)
    return text


def quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def _case(column: str, values: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items())
    return f"CASE {column} {whens} END"


def _exploded(names, column: str) -> str:
    """One row per name. Values are computed after the rows of other names are filtered out."""
    return f"explode(array({quoted(names)})) AS {column}"


def _numbered(count: int) -> str:
    return f"explode(array({', '.join(str(i) for i in range(count))})) AS n"


def measurement_rows(events: DataFrame, name: str) -> DataFrame:
    """Series rows of a measurement from the events of ``Tables``."""
    formulas, copies, tags, key = SERIES[name]
    specs = {f.name: f for f in CATALOG[name].fields}
    pairs = ", ".join(f"'{n}', {text}" for n, text in tags.items())
    value = _case("field", {f: f"CAST({text} AS DOUBLE)" for f, text in formulas.items()})
    kind = _case("field", {f: f"'{specs[f].kind}'" for f in formulas})
    unit = _case("field", {f: f"'{specs[f].unit}'" for f in formulas})
    return (
        events.selectExpr("*", _numbered(copies))
        .selectExpr("*", _exploded(formulas, "field"))
        .selectExpr(
            "ts", f"{CONTRACT_VERSION} AS contract_version", "run_id", "target_id", "host",
            "tier", f"'{name}' AS measurement", "field", f"{value} AS value",
            f"{kind} AS kind", f"{unit} AS unit", f"{key} AS series_key",
            f"CAST(map({pairs}) AS map<string,string>) AS tags",
        )
    )


def series_rows(events: DataFrame) -> DataFrame:
    """Series rows of all measurements."""
    union = None
    for name in SERIES:
        frame = measurement_rows(events, name)
        union = frame if union is None else union.union(frame)
    return union


def metric_rows(events: DataFrame) -> DataFrame:
    """Legacy metric rows."""
    source = _case("metric", {m: f"'{spec[0]}'" for m, spec in LEGACY_FORMULAS.items()})
    value = _case(
        "metric", {m: f"CAST({spec[1]} AS DOUBLE)" for m, spec in LEGACY_FORMULAS.items()}
    )
    return events.selectExpr("*", _exploded(LEGACY_FORMULAS, "metric")).selectExpr(
        "ts", "run_id",
        "CASE WHEN event_type = 'error' THEN concat('old-', host) ELSE host END AS host",
        "tier", f"{source} AS source", "metric", f"{value} AS value",
    )


class Tables:
    """Frames over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = prepare(spark)
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        """A given table, with its zone-less times read as UTC."""
        frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if not any(t == "timestamp_ntz" for _, t in frame.dtypes):
            return frame
        return frame.selectExpr(*[
            f"CAST({n} AS TIMESTAMP) AS {n}" if t == "timestamp_ntz" else n
            for n, t in frame.dtypes
        ])

    @cached_property
    def events(self) -> DataFrame:
        """Events with the derived columns all formulas use."""
        return self.raw("events").selectExpr(
            "event_id", "ts", "user_id", "event_type", "value", "props",
            "CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k",
            "CAST(round(value * 100) AS BIGINT) AS cents",
            f"pmod(unix_seconds(ts), {WEEK}) AS ws",
            "CASE WHEN user_id % 2 = 0 THEN 'run-base' ELSE 'run-cand' END AS run_id",
            "concat('target-', (user_id div 2) % 3) AS target_id",
            "concat('target-', (user_id div 2) % 3, '.db') AS host",
            "CASE WHEN user_id % 2 = 0 THEN 'premium-ssd-v1' ELSE 'premium-ssd-v2' END AS tier",
            "CASE event_type WHEN 'view' THEN 'read' WHEN 'click' THEN 'write' ELSE 'misc' END "
            "AS mode",
        )

    def measurement(self, name: str) -> DataFrame:
        return measurement_rows(self.events, name)

    @cached_property
    def series(self) -> DataFrame:
        """Narrow series table. A filter on the measurement leaves only its branch to read."""
        return series_rows(self.events)

    @cached_property
    def points(self) -> DataFrame:
        """Packed point table without its fields."""
        kinds = [(m, n) for m, spec in SERIES.items() for n in range(spec[1])]
        rows = ", ".join(f"named_struct('measurement', '{m}', 'n', {n})" for m, n in kinds)
        key = _case("measurement", {m: spec[3] for m, spec in SERIES.items()})
        return (
            self.events.selectExpr("*", f"inline(array({rows}))")
            .selectExpr(
                "ts", f"{CONTRACT_VERSION} AS contract_version", "run_id", "target_id", "host",
                "tier", "measurement", f"{key} AS series_key",
            )
        )

    @cached_property
    def metrics(self) -> DataFrame:
        """Legacy metric table; error events come from hosts that have no series."""
        return metric_rows(self.events)

    @cached_property
    def error_log(self) -> DataFrame:
        """Server error log rows with their context."""
        return self.events.selectExpr(
            "ts AS logged", "run_id", "target_id", "host", "tier",
            "'collector-01' AS collector_id",
            "CASE k % 4 WHEN 0 THEN 'Error' WHEN 1 THEN 'Warning' WHEN 2 THEN 'System' END AS prio",
            "concat('MY-', lpad(CAST(k AS STRING), 6, '0')) AS error_code",
            "CASE k % 5 WHEN 0 THEN 'InnoDB' WHEN 1 THEN 'Server' WHEN 2 THEN 'Repl' END "
            "AS subsystem",
            "props AS data",
        )

    @cached_property
    def log_events(self) -> DataFrame:
        """Event table."""
        return self.error_log.selectExpr(
            "logged AS ts", "run_id", "target_id", "host", "tier", "'error_log' AS source",
            "coalesce(prio, '') AS level", "error_code", "coalesce(subsystem, '') AS subsystem",
            "data AS message", "collector_id",
        )

    @cached_property
    def cycles(self) -> DataFrame:
        """Per-cycle collector log."""
        return self.events.selectExpr(
            "ts AS observed_at", "run_id", "target_id", "host", "tier", "'' AS resource_id",
            "'collector-01' AS collector_id", "k % 10 <> 0 AS reachable",
            "CASE WHEN k % 7 <> 0 THEN value END AS duration_ms",
        )

    @cached_property
    def _orders(self) -> DataFrame:
        # Days are squeezed to ten minutes so that neighbouring time bins are filled.
        return self.raw("orders").selectExpr(
            "*",
            "timestamp_seconds(1704067200 + datediff(o_orderdate, DATE '1995-01-01') * 600 "
            "+ o_orderkey % 600) AS time_generated",
        )

    @cached_property
    def platform_metrics(self) -> DataFrame:
        number = _case("metric_name", {m: str(i) for i, m in enumerate(PLATFORM_METRICS)})
        return (
            self._orders.selectExpr("*", _exploded(PLATFORM_METRICS, "metric_name"))
            .selectExpr("*", f"{number} AS n")
            .selectExpr(
                "time_generated", "metric_name", "concat('server-', o_custkey % 3) AS resource",
                "((o_custkey * 7 + n * 13) % 1000) / 8e0 AS average",
                "((o_custkey * 7 + n * 13) % 1000 + o_orderkey % 50) / 8e0 AS maximum",
                "CAST(floor(o_totalprice / 20000) + n AS DOUBLE) AS total",
            )
        )

    @cached_property
    def diagnostics(self) -> DataFrame:
        """Slow statements from line items, audit rows from events."""
        slow = self.raw("lineitem").selectExpr(
            "l_shipdate AS time_generated", "'MySqlSlowLogs' AS category",
            "concat('server-', l_suppkey % 3) AS resource", "l_returnflag AS db_s",
            "concat('client-', l_suppkey % 7) AS host_s",
            "concat_ws('-', 'stmt', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS sql_text_s",
            "l_extendedprice AS query_time_d", "l_tax AS lock_time_d",
            "CAST(l_linenumber - 1 AS DOUBLE) AS rows_sent_d",
            "l_quantity * 100 AS rows_examined_d",
        )
        audit = self.events.selectExpr(
            "ts AS time_generated", "'MySqlAuditLogs' AS category", "target_id AS resource",
            "concat('10.0.0.', user_id % 20) AS ip_s", "concat('user', user_id) AS user_s",
            "event_type AS db_s",
            "CASE WHEN event_type IN ('view', 'click') THEN 'general_log' "
            "ELSE 'connection_log' END AS event_class_s",
            "upper(event_type) AS event_subclass_s", "'false' AS is_aad_auth_s",
            "props AS sql_text_s",
            "CAST(CASE k % 3 WHEN 0 THEN 1045 WHEN 1 THEN 1044 ELSE 0 END AS DOUBLE) "
            "AS error_code_d",
        )
        return slow.unionByName(audit, allowMissingColumns=True)

    @cached_property
    def activity(self) -> DataFrame:
        operation = _case("o_orderpriority", {k: f"'{v}'" for k, v in OPERATIONS.items()})
        return self._orders.selectExpr(
            "time_generated",
            "CASE WHEN o_custkey % 10 = 0 THEN 'MICROSOFT.STORAGE' "
            "ELSE 'MICROSOFT.DBFORMYSQL' END AS resource_provider",
            f"{operation} AS operation_name",
            "CASE o_orderstatus WHEN 'F' THEN 'Success' WHEN 'O' THEN 'Started' "
            "ELSE 'Failed' END AS activity_status",
            "'' AS activity_substatus", "concat('caller-', o_custkey % 9) AS caller",
            "'10.1.0.1' AS caller_ip", "'group-1' AS resource_group",
            "concat('target-', o_custkey % 3) AS resource_id",
            "concat('corr-', o_orderkey) AS correlation_id",
        )

    @cached_property
    def oplog(self) -> DataFrame:
        """Operation log of a load run; the return flag names the repetition."""
        return self.raw("lineitem").selectExpr(
            "l_returnflag AS run_id",
            "CASE WHEN l_linestatus = 'F' THEN 'read' ELSE 'write' END AS kind",
            "CASE WHEN l_linenumber < 5 THEN 'completed' WHEN l_linenumber = 5 "
            "THEN 'dropped_late' WHEN l_linenumber = 6 THEN 'dropped_queue' ELSE 'error' END "
            "AS outcome",
            "l_extendedprice / 100 AS latency_ms",
        )

    def snapshot(self, name: str) -> DataFrame:
        """A server snapshot table."""
        names = f"element_at(array({quoted(STATUS_NAMES)}), CAST(c_custkey % 95 + 1 AS INT))"
        used = {
            table: self.raw(table)
            for table in ("lineitem", "customer", "part", "orders")
            if "{" + table + "}" in SNAPSHOTS[name]
        }
        return self.spark.sql(snapshot_sql(name, "div", names), **used)

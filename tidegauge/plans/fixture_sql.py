"""The tables of ``fixtures`` as common table expressions of the checking engine."""

from __future__ import annotations

import re

from tidegauge.catalog import STATUS_NAMES
from tidegauge.plans.fixtures import (
    LEGACY_FORMULAS,
    OPERATIONS,
    PLATFORM_METRICS,
    SERIES,
    SNAPSHOTS,
    WEEK,
    quoted,
    snapshot_sql,
)

_TAG_NAMES = ("event", "mode", "schema", "digest")


def _rows(pairs) -> str:
    return ", ".join(
        "{" + ", ".join(f"'{k}': {v}" for k, v in row.items()) + "}" for row in pairs
    )


def _measurement(name: str) -> str:
    formulas, copies, tags, key = SERIES[name]
    fields = _rows(
        {"field": f"'{f}'", "value": f"CAST({text} AS DOUBLE)"} for f, text in formulas.items()
    )
    tag_columns = ", ".join(f"{tags.get(t, chr(39) * 2)} AS tag_{t}" for t in _TAG_NAMES)
    return f"""
        SELECT ts, 2 AS contract_version, run_id, target_id, host, tier, measurement, series_key,
               tag_event, tag_mode, tag_schema, tag_digest, u.field AS field, u.value AS value
        FROM (SELECT *, '{name}' AS measurement, {key} AS series_key, {tag_columns},
                     unnest([{fields}]) AS u
              FROM (SELECT *, unnest(range({copies})) AS n FROM ev))
    """


def _key_case() -> str:
    cases = " ".join(f"WHEN measurement = '{m}' THEN {spec[3]}" for m, spec in SERIES.items())
    return f"CASE {cases} END"


def _orders() -> str:
    return """
        SELECT *, make_timestamp(CAST((1704067200
                 + date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) * 600
                 + o_orderkey % 600) AS BIGINT) * 1000000) AS time_generated
        FROM orders
    """


def _ctes() -> dict[str, str]:
    ctes = {
        "ev": f"""
            SELECT event_id, ts, user_id, event_type, value, props,
                   CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
                   CAST(round(value * 100) AS BIGINT) AS cents,
                   (epoch_us(ts) // 1000000) % {WEEK} AS ws,
                   CASE WHEN user_id % 2 = 0 THEN 'run-base' ELSE 'run-cand' END AS run_id,
                   concat('target-', (user_id // 2) % 3) AS target_id,
                   concat('target-', (user_id // 2) % 3, '.db') AS host,
                   CASE WHEN user_id % 2 = 0 THEN 'premium-ssd-v1' ELSE 'premium-ssd-v2' END
                       AS tier,
                   CASE event_type WHEN 'view' THEN 'read' WHEN 'click' THEN 'write'
                        ELSE 'misc' END AS mode
            FROM events
        """,
        "series": " UNION ALL ".join(_measurement(m) for m in SERIES),
        "points": f"""
            SELECT ts, 2 AS contract_version, run_id, target_id, host, tier, measurement,
                   {_key_case()} AS series_key
            FROM (SELECT *, u.measurement AS measurement, u.n AS n
                  FROM (SELECT *, unnest([{_rows(
                      {"measurement": f"'{m}'", "n": n}
                      for m, spec in SERIES.items() for n in range(spec[1]))}]) AS u FROM ev))
        """,
        "metrics": f"""
            SELECT ts, run_id, CASE WHEN event_type = 'error' THEN concat('old-', host)
                               ELSE host END AS host,
                   tier, u.source AS source, u.metric AS metric, u.value AS value
            FROM (SELECT *, unnest([{_rows(
                {"source": f"'{source}'", "metric": f"'{m}'", "value": f"CAST({text} AS DOUBLE)"}
                for m, (source, text) in LEGACY_FORMULAS.items())}]) AS u FROM ev)
        """,
        "error_log": """
            SELECT ts AS logged, run_id, target_id, host, tier, 'collector-01' AS collector_id,
                   CASE k % 4 WHEN 0 THEN 'Error' WHEN 1 THEN 'Warning' WHEN 2 THEN 'System' END
                       AS prio,
                   concat('MY-', lpad(CAST(k AS VARCHAR), 6, '0')) AS error_code,
                   CASE k % 5 WHEN 0 THEN 'InnoDB' WHEN 1 THEN 'Server' WHEN 2 THEN 'Repl' END
                       AS subsystem,
                   props AS data
            FROM ev
        """,
        "log_events": """
            SELECT logged AS ts, run_id, target_id, host, tier, 'error_log' AS source,
                   coalesce(prio, '') AS level, error_code, coalesce(subsystem, '') AS subsystem,
                   data AS message, collector_id
            FROM error_log
        """,
        "cycles": """
            SELECT ts AS observed_at, run_id, target_id, host, tier, k % 10 <> 0 AS reachable,
                   CASE WHEN k % 7 <> 0 THEN value END AS duration_ms
            FROM ev
        """,
        "squeezed_orders": _orders(),
        "platform_metrics": f"""
            SELECT time_generated, concat('server-', o_custkey % 3) AS resource,
                   u.metric_name AS metric_name, u.average AS average, u.maximum AS maximum,
                   u.total AS total
            FROM (SELECT *, unnest([{_rows(
                {"metric_name": f"'{m}'",
                 "average": f"((o_custkey * 7 + {i * 13}) % 1000) / 8e0",
                 "maximum": f"((o_custkey * 7 + {i * 13}) % 1000 + o_orderkey % 50) / 8e0",
                 "total": f"CAST(floor(o_totalprice / 20000) + {i} AS DOUBLE)"}
                for i, m in enumerate(PLATFORM_METRICS))}]) AS u FROM squeezed_orders)
        """,
        "slow_log": """
            SELECT l_shipdate AS time_generated, concat('server-', l_suppkey % 3) AS resource,
                   l_returnflag AS db_s, concat('client-', l_suppkey % 7) AS host_s,
                   concat_ws('-', 'stmt', l_orderkey, l_linenumber, l_partkey, l_suppkey)
                       AS sql_text_s,
                   l_extendedprice AS query_time_d, l_tax AS lock_time_d,
                   l_linenumber - 1 AS rows_sent_d, l_quantity * 100 AS rows_examined_d
            FROM lineitem
        """,
        "audit_log": """
            SELECT ts AS time_generated, target_id AS resource,
                   concat('10.0.0.', user_id % 20) AS ip_s, concat('user', user_id) AS user_s,
                   event_type AS db_s,
                   CASE WHEN event_type IN ('view', 'click') THEN 'general_log'
                        ELSE 'connection_log' END AS event_class_s,
                   upper(event_type) AS event_subclass_s, 'false' AS is_aad_auth_s,
                   props AS sql_text_s,
                   CAST(CASE k % 3 WHEN 0 THEN 1045 WHEN 1 THEN 1044 ELSE 0 END AS BIGINT)
                       AS error_code_d
            FROM ev
        """,
        "activity": f"""
            SELECT time_generated,
                   CASE WHEN o_custkey % 10 = 0 THEN 'MICROSOFT.STORAGE'
                        ELSE 'MICROSOFT.DBFORMYSQL' END AS resource_provider,
                   CASE o_orderpriority {" ".join(
                       f"WHEN '{p}' THEN '{n}'" for p, n in OPERATIONS.items())} END
                       AS operation_name,
                   CASE o_orderstatus WHEN 'F' THEN 'Success' WHEN 'O' THEN 'Started'
                        ELSE 'Failed' END AS activity_status,
                   '' AS activity_substatus, concat('caller-', o_custkey % 9) AS caller,
                   '10.1.0.1' AS caller_ip, 'group-1' AS resource_group,
                   concat('target-', o_custkey % 3) AS resource_id,
                   concat('corr-', o_orderkey) AS correlation_id
            FROM squeezed_orders
        """,
        "oplog": """
            SELECT l_returnflag AS run_id,
                   CASE WHEN l_linestatus = 'F' THEN 'read' ELSE 'write' END AS kind,
                   CASE WHEN l_linenumber < 5 THEN 'completed'
                        WHEN l_linenumber = 5 THEN 'dropped_late'
                        WHEN l_linenumber = 6 THEN 'dropped_queue' ELSE 'error' END AS outcome,
                   l_extendedprice / 100 AS latency_ms
            FROM lineitem
        """,
    }
    names = f"list_extract([{quoted(STATUS_NAMES)}], c_custkey % 95 + 1)"
    for name in SNAPSHOTS:
        text = snapshot_sql(name, "//", names)
        ctes[name] = re.sub(r"\{(lineitem|customer|part|orders)\}", r"\1", text)
    return ctes


CTES = _ctes()


def with_tables(select: str, extra: dict[str, str] | None = None) -> str:
    """The query with all table expressions it refers to, directly or not."""
    known = {**CTES, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if re.search(rf"\b(FROM|JOIN)\s+{name}\b", text) and name not in needed:
                visit(known[name])
                needed.append(name)

    visit(select)
    if not needed:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in needed) + select

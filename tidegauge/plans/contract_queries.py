"""Point contract and snapshot normalizers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.catalog import STATUS_NAMES
from tidegauge.functions.tags import series_key
from tidegauge.functions.timing import utc_iso
from tidegauge.operators import contract as c
from tidegauge.operators import normalize as n
from tidegauge.plans.fixtures import quoted
from tidegauge.plans.registry import query, r

# --- wire rows with faults ------------------------------------------------------------------

_NORMAL = "concat('{\"operations_total\":', k, ',\"bytes_total\":', k * 512, ',\"wait_ms_total\":', k"
#: Columns of a wire row, in text both engines read. The fault is chosen by the event number.
WIRE = {
    "fault": "event_id % 50",
    "measurement": """CASE WHEN event_id % 50 = 8 THEN 'mysql.unknown' WHEN event_id % 50 = 17 THEN ''
        WHEN event_id % 50 BETWEEN 18 AND 24 THEN 'collector.health' ELSE 'mysql.file_io' END""",
    "run_id": "CASE WHEN event_id % 50 = 6 THEN '  ' ELSE run_id END",
    "tags_text": """CASE WHEN event_id % 50 IN (2, 12)
             THEN concat('{"event":"class-', k % 3, '","mode":"', mode, '","zone":"z"}')
        WHEN event_id % 50 = 3 THEN concat('{"event":"class-', k % 3, '"}')
        WHEN event_id % 50 = 15 THEN concat('{"mode":"', mode, '","event":"class-', k % 3, '"}')
        WHEN event_id % 50 = 16 THEN concat('{"event":"clé ', k % 3, '","mode":"', mode, '"}')
        WHEN event_id % 50 BETWEEN 18 AND 24 THEN '{}'
        ELSE concat('{"event":"class-', k % 3, '","mode":"', mode, '"}') END""",
    "fields_text": f"""CASE event_id % 50
        WHEN 0 THEN concat('{{"operations_total":', k, ',"bytes_total":', k * 512, '}}')
        WHEN 1 THEN {_NORMAL}, '.25,"extra":1}}')
        WHEN 4 THEN '{{"operations_total":true,"bytes_total":1,"wait_ms_total":1.5}}'
        WHEN 5 THEN {_NORMAL}, '}}')
        WHEN 9 THEN '{{}}'
        WHEN 10 THEN '{{"operations_total":1,"bytes_total":2,"wait_ms_total":"slow"}}'
        WHEN 11 THEN '{{"operations_total":1,"bytes_total":2,"wait_ms_total":0.5,"":3}}'
        WHEN 12 THEN '{{"operations_total":1,"bytes_total":2}}'
        WHEN 13 THEN '{{"operations_total":1,"bytes_total":2.5,"wait_ms_total":0.5}}'
        WHEN 17 THEN '{{"operations_total":12345678901234567890.0,"bytes_total":2,"wait_ms_total":0.5}}'
        WHEN 14 THEN '{{"operations_total":null,"bytes_total":2,"wait_ms_total":0.5}}'
        ELSE CASE WHEN event_id % 50 BETWEEN 18 AND 24
                  THEN concat('{{"heartbeat":1,"mysql_reachable":', k % 2,
                              ',"cycle_duration_ms":', k, '.25}}')
                  ELSE {_NORMAL}, '.25}}') END END""",
}


def wire_rows(t):
    """Wire rows, with their event number and time left in."""
    return t.events.selectExpr(
        "event_id", "ts AS observed_at",
        "CASE WHEN event_id % 50 = 7 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") "
        "ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") END AS ts",
        "ts AS _ts", f"{WIRE['run_id']} AS run_id", "target_id", "host", "tier",
        f"{WIRE['measurement']} AS measurement",
        f"from_json({WIRE['tags_text']}, 'map<string,string>') AS tags",
        f"{WIRE['fields_text']} AS fields_text",
    ).drop("_ts").withColumn("fields", c.exact_kinds(
        F.from_json("fields_text", "map<string,variant>"), F.col("fields_text"),
        F.from_json("fields_text", "map<string,string>"),
    )).drop("fields_text")


def _checked(t):
    rows = wire_rows(t).withColumn("ts_text", F.col("ts"))
    return c.check_points(c.point_from_row(rows), c.naive_text("ts_text"))


def _valid(t):
    return _checked(t).filter(F.col("problem").isNull())


_FILE = "['operations_total', 'bytes_total', 'wait_ms_total']"
_HEALTH = "['heartbeat', 'mysql_reachable', 'cycle_duration_ms']"
_WORDS = """CASE json_type(fields_text, concat('$.', x)) WHEN 'BOOLEAN' THEN 'bool'
    WHEN 'DOUBLE' THEN 'float' WHEN 'VARCHAR' THEN 'str' WHEN 'NULL' THEN 'NoneType' ELSE 'int' END"""
TABLES = {
    "wire": f"""
        SELECT event_id, ts, {WIRE['run_id']} AS run_id, target_id, host, tier, k,
               {WIRE['measurement']} AS measurement, {WIRE['tags_text']} AS tags_text,
               {WIRE['fields_text']} AS fields_text, event_id % 50 = 7 AS naive, mode
        FROM ev
    """,
    "invariants": """
        SELECT *, CASE WHEN trim(run_id) = '' THEN 'telemetry context requires: run_id'
                       WHEN naive THEN 'observed_at must be timezone-aware'
                       WHEN measurement = '' THEN 'measurement must not be empty'
                       WHEN fields_text = '{}'
                       THEN concat(measurement, ' must contain at least one field')
                       WHEN list_contains(json_keys(fields_text), '')
                       THEN concat(measurement, ' contains an empty field name') END AS invariant
        FROM wire
    """,
    "shaped": f"""
        SELECT *, json_keys(fields_text) AS names, json_keys(tags_text) AS tags,
               CASE measurement WHEN 'mysql.file_io' THEN {_FILE}
                    WHEN 'collector.health' THEN {_HEALTH} END AS known,
               CASE measurement WHEN 'mysql.file_io' THEN {_FILE}
                    ELSE ['heartbeat', 'mysql_reachable'] END AS required,
               CASE measurement WHEN 'mysql.file_io' THEN ['event', 'mode']
                    ELSE [] END AS known_tags
        FROM invariants
    """,
    "found": f"""
        SELECT *, list_filter([
                   list_filter(names, lambda x: NOT list_contains(known, x)),
                   list_filter(required, lambda x: NOT list_contains(names, x)),
                   list_filter(tags, lambda x: NOT list_contains(known_tags, x)),
                   list_filter(known_tags, lambda x: NOT list_contains(tags, x))
               ], lambda y: true) AS parts,
               list_filter(list_transform(
                   list_filter(names, lambda x: list_contains(known, x)),
                   lambda x: CASE WHEN x IN ('operations_total', 'bytes_total')
                                   AND {_WORDS} <> 'int'
                                  THEN concat(measurement, '.', x, ' expects int, got ', {_WORDS})
                                  WHEN x NOT IN ('operations_total', 'bytes_total')
                                   AND {_WORDS} NOT IN ('int', 'float')
                                  THEN concat(measurement, '.', x, ' expects float, got ', {_WORDS})
                             END), lambda z: z IS NOT NULL) AS mistyped
        FROM shaped
    """,
    "checked": """
        SELECT *, CASE WHEN invariant IS NOT NULL THEN invariant
                       WHEN known IS NULL THEN concat('unknown measurement ''', measurement, '''')
                       WHEN len(parts[1]) + len(parts[2]) + len(parts[3]) + len(parts[4]) > 0
                       THEN concat(measurement, ': ', array_to_string(list_filter([
                           CASE WHEN len(parts[1]) > 0 THEN concat('unknown fields: ',
                               array_to_string(list_sort(parts[1]), ', ')) END,
                           CASE WHEN len(parts[2]) > 0 THEN concat('missing fields: ',
                               array_to_string(list_sort(parts[2]), ', ')) END,
                           CASE WHEN len(parts[3]) > 0 THEN concat('unknown tags: ',
                               array_to_string(list_sort(parts[3]), ', ')) END,
                           CASE WHEN len(parts[4]) > 0 THEN concat('missing tags: ',
                               array_to_string(list_sort(parts[4]), ', ')) END
                       ], lambda x: x IS NOT NULL), '; '))
                       WHEN len(mistyped) > 0 THEN mistyped[1] END AS problem
        FROM found
    """,
    "identified": r"""
        SELECT *, CASE WHEN event_id % 50 BETWEEN 18 AND 24 THEN '{}'
                       ELSE concat('{"event":"',
                           CASE WHEN event_id % 50 = 16 THEN concat('cl\u00e9 ', k % 3)
                                ELSE concat('class-', k % 3) END, '","mode":"', mode, '"}')
                  END AS canonical
        FROM checked
    """,
    "keyed": """
        SELECT *, substring(sha256(concat('{"measurement":"', measurement, '","tags":', canonical,
                  ',"target_id":"', target_id, '"}')), 1, 24) AS series_key
        FROM identified WHERE problem IS NULL
    """,
}


@query("validate_points", "SELECT event_id, problem IS NULL AS valid, problem FROM checked", TABLES)
def _validate_points(t):
    return _checked(t).select("event_id", F.col("problem").isNull().alias("valid"), "problem")


@query("point_invariants", "SELECT event_id, invariant AS problem FROM invariants", TABLES)
def _point_invariants(t):
    rows = wire_rows(t)
    return rows.select("event_id", c.invariant_problem(c.naive_text("ts")).alias("problem"))


@query("series_key", "SELECT event_id, series_key FROM keyed", TABLES)
def _series_key(t):
    return _valid(t).select(
        "event_id",
        series_key(F.col("target_id"), F.col("measurement"), F.col("tags")).alias("series_key"),
    )


@query(
    "packed_row",
    """
    SELECT ts, 2 AS contract_version, run_id, target_id, host, '' AS resource_id, tier,
           '' AS collector_id, measurement, series_key, fields_text AS fields
    FROM keyed
    """,
    TABLES,
)
def _packed_row(t):
    return c.packed_row(_valid(t)).withColumn("fields", F.to_json("fields")).drop("tags")


_UNITS = "CASE x WHEN 'operations_total' THEN 'operations' WHEN 'bytes_total' THEN 'bytes' " \
         "WHEN 'wait_ms_total' THEN 'ms' WHEN 'cycle_duration_ms' THEN 'ms' ELSE 'state' END"
_NUMBER = r("CAST(json_extract_string(fields_text, concat('$.', x)) AS DOUBLE)", "value")


@query(
    "series_rows",
    f"""
    SELECT ts, 2 AS contract_version, run_id, target_id, host, tier, measurement, x AS field,
           {_NUMBER}, CASE measurement WHEN 'mysql.file_io' THEN 'counter' ELSE 'gauge' END AS kind,
           {_UNITS} AS unit, series_key
    FROM (SELECT *, unnest(names) AS x FROM keyed)
    """,
    TABLES,
)
def _series_rows(t):
    return c.series_rows(c.packed_row(_valid(t))).drop("tags")


@query(
    "legacy_metric_rows",
    f"""
    SELECT ts, run_id, host, tier, 'collector' AS source,
           CASE x WHEN 'heartbeat' THEN 'collector_heartbeat' ELSE x END AS metric, {_NUMBER}
    FROM (SELECT *, unnest(names) AS x FROM keyed WHERE measurement = 'collector.health')
    """,
    TABLES,
)
def _legacy_metric_rows(t):
    health = _valid(t).filter(F.col("measurement") == "collector.health")
    return c.legacy_metric_rows(health, "collector", {"heartbeat": "collector_heartbeat"})


@query("utc_iso", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso FROM ev")
def _utc_iso(t):
    return t.events.select("event_id", utc_iso(F.col("ts")).alias("iso"))


@query(
    "point_from_row",
    """
    SELECT event_id, CASE WHEN NOT naive THEN ts END AS ts, run_id, target_id, host, tier,
           '' AS resource_id, '' AS collector_id, measurement
    FROM wire
    """,
    TABLES,
)
def _point_from_row(t):
    return c.point_from_row(wire_rows(t)).drop("tags", "fields", "observed_at")


# --- normalizers ----------------------------------------------------------------------------


def flat(points):
    """One row per field of a point, for comparison."""
    pairs = F.transform(
        F.array_sort(F.map_entries("tags")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    kind = c.value_type(F.col("variant"))
    return points.select(
        "ts", "run_id", "target_id", "measurement", F.array_join(pairs, ",").alias("tags"),
        F.explode("fields").alias("field", "variant"),
    ).select(
        "ts", "run_id", "target_id", "measurement", "tags", "field", kind.alias("kind"),
        F.when(kind != "str", F.try_variant_get("variant", "$", "double")).alias("number"),
        F.when(kind == "str", F.try_variant_get("variant", "$", "string")).alias("text"),
    )


def flat_sql(measurement: str, tags: dict[str, str], fields: dict[str, tuple[str, str]],
             source: str, where: str = "true") -> str:
    """The same rows from a snapshot: fields map to (kind, expression)."""
    listed = " || ',' || ".join(f"'{k}=' || {tags[k]}" for k in sorted(tags)) or "''"
    structs = ", ".join(
        "{" + f"'field': '{f}', 'kind': '{kind}', "
        f"'number': {f'CAST({e} AS DOUBLE)' if kind != 'str' else 'CAST(NULL AS DOUBLE)'}, "
        f"'text': {e if kind == 'str' else 'CAST(NULL AS VARCHAR)'}" + "}"
        for f, (kind, e) in fields.items()
    )
    return f"""
        SELECT ts, run_id, target_id, measurement, tags, u.field AS field, u.kind AS kind,
               {r('u.number', 'number')}, u.text AS text
        FROM (SELECT observed_at AS ts, run_id, target_id, '{measurement}' AS measurement,
                     {listed} AS tags, unnest([{structs}]) AS u
              FROM {source} WHERE {where})
    """


def ranked(source: str, where: str, order: str) -> str:
    return (
        f"(SELECT *, row_number() OVER (PARTITION BY run_id, target_id, observed_at "
        f"ORDER BY {order}) AS place FROM {source} WHERE {where})"
    )


def _n(column: str) -> tuple[str, str]:
    return ("int", f"coalesce({column}, 0)")


def _ms(column: str) -> tuple[str, str]:
    return ("float", f"coalesce({column}, 0) / 1e9")


#: Numeric text by the rules of the collector.
_FLOAT = ("CASE WHEN regexp_matches(variable_value, '^[0-9]+(_[0-9]+)*(\\.[0-9]+)?$') "
          "THEN CAST(replace(variable_value, '_', '') AS DOUBLE) "
          "WHEN regexp_matches(variable_value, '^-[0-9]+(\\.[0-9]+)?$') "
          "THEN CAST(variable_value AS DOUBLE) END")
_STATUS = f"variable_name IN ({quoted(STATUS_NAMES)}) AND {_FLOAT} IS NOT NULL"


@query(
    "norm_global_status",
    f"""
    SELECT observed_at AS ts, run_id, target_id, 'mysql.global_status' AS measurement, '' AS tags,
           variable_name AS field, 'float' AS kind, {r(_FLOAT, 'number')},
           CAST(NULL AS VARCHAR) AS text
    FROM status WHERE {_STATUS}
    """,
)
def _norm_global_status(t):
    return flat(n.norm_global_status(t.snapshot("status")))


_TOP_FILES = ranked("files", "count_star > 0", "sum_timer_wait DESC, event_name")


@query(
    "norm_file_io",
    " UNION ALL ".join(
        flat_sql(
            "mysql.file_io", {"event": "event_name", "mode": f"'{mode}'"},
            {"operations_total": _n(f"count_{mode}"), "bytes_total": ("int", size),
             "wait_ms_total": _ms(f"sum_timer_{mode}")},
            _TOP_FILES, "place <= 60",
        )
        for mode, size in (
            ("read", "coalesce(sum_number_of_bytes_read, 0)"),
            ("write", "coalesce(sum_number_of_bytes_write, 0)"), ("misc", "0"),
        )
    ),
)
def _norm_file_io(t):
    return flat(n.norm_file_io(t.snapshot("files"), 60))


_DIGEST_FIELDS = {
    "executions_total": _n("count_star"), "latency_ms_total": _ms("sum_timer_wait"),
    "lock_ms_total": _ms("sum_lock_time"), "rows_examined_total": _n("sum_rows_examined"),
    "rows_sent_total": _n("sum_rows_sent"), "errors_total": _n("sum_errors"),
    "warnings_total": _n("sum_warnings"), "tmp_tables_total": _n("sum_created_tmp_tables"),
    "tmp_disk_tables_total": _n("sum_created_tmp_disk_tables"),
    "no_index_used_total": _n("sum_no_index_used"), "latency_p95_ms": _ms("quantile_95"),
    "latency_p99_ms": _ms("quantile_99"),
}
_DIGEST_ORDER = "sum_timer_wait DESC, schema_name NULLS FIRST, digest"


@query(
    "norm_statement_digest",
    flat_sql(
        "mysql.statement_digest",
        {"schema": "coalesce(nullif(schema_name, ''), '(none)')", "digest": "digest"},
        _DIGEST_FIELDS, ranked("digests", "digest IS NOT NULL", _DIGEST_ORDER), "place <= 50",
    ),
)
def _norm_statement_digest(t):
    return flat(n.norm_statement_digest(t.snapshot("digests")))


_ENGINE_TAGS = {"name": "name", "subsystem": "subsystem", "metric_type": "type"}


@query(
    "norm_innodb_metric",
    flat_sql("mysql.innodb_metric", _ENGINE_TAGS, {"counter_value": _n('"count"')},
             "engine_metrics", "status = 'enabled' AND type IN ('counter', 'status_counter')")
    + " UNION ALL "
    + flat_sql("mysql.innodb_metric", _ENGINE_TAGS,
               {"gauge_value": ("float", 'coalesce("count", 0)')},
               "engine_metrics", "status = 'enabled' AND type NOT IN ('counter', 'status_counter')"),
)
def _norm_innodb_metric(t):
    return flat(n.norm_innodb_metric(t.snapshot("engine_metrics")))


@query(
    "norm_global_variable",
    flat_sql("mysql.global_variable", {"name": "variable_name"},
             {"numeric_value": ("float", _FLOAT)}, "variables", f"{_FLOAT} IS NOT NULL")
    + " UNION ALL "
    + flat_sql("mysql.global_variable", {"name": "variable_name"},
               {"text_value": ("str", "coalesce(variable_value, 'None')")}, "variables",
               f"{_FLOAT} IS NULL"),
)
def _norm_global_variable(t):
    return flat(n.norm_global_variable(t.snapshot("variables")))


@query(
    "norm_process_state",
    flat_sql(
        "mysql.process_state",
        {"command": "coalesce(nullif(command, ''), '(none)')",
         "state": "coalesce(nullif(state, ''), '(none)')"},
        {"sessions": ("int", "sessions"), "oldest_seconds": ("int", "oldest")},
        "(SELECT run_id, target_id, observed_at, command, state, count(*) AS sessions, "
        "max(time) AS oldest FROM sessions GROUP BY ALL)",
    ),
)
def _norm_process_state(t):
    return flat(n.norm_process_state(t.snapshot("sessions")))


_NOT_SYSTEM = "NOT IN ('mysql', 'information_schema', 'performance_schema', 'sys')"


@query(
    "norm_schema_size",
    flat_sql(
        "mysql.schema_size",
        {"schema": "table_schema", "table": "table_name", "engine": "engine"},
        {"rows_estimate": _n("table_rows"), "data_bytes": _n("data_length"),
         "index_bytes": _n("index_length"), "free_bytes": _n("data_free")},
        ranked("tables", f"table_type = 'BASE TABLE' AND engine IS NOT NULL AND table_schema "
               f"{_NOT_SYSTEM}", "data_length + index_length DESC, table_schema, table_name"),
        "place <= 50",
    ),
)
def _norm_schema_size(t):
    return flat(n.norm_schema_size(t.snapshot("tables"), 50))


def _io(*operations: str) -> dict[str, tuple[str, str]]:
    fields = {}
    for operation in operations:
        fields[f"{operation}_total"] = _n(f"count_{operation}")
        fields[f"{operation}_wait_ms_total"] = _ms(f"sum_timer_{operation}")
    return fields


#: Table rows: the index rows of the fixture summed by table.
_TABLE_IO = "(SELECT run_id, target_id, observed_at, object_schema, object_name, " + ", ".join(
    f"CAST(sum({c}) AS BIGINT) AS {c}" for c in (
        "count_star", "sum_timer_wait", "count_fetch", "sum_timer_fetch", "count_insert",
        "sum_timer_insert", "count_update", "sum_timer_update", "count_delete",
        "sum_timer_delete")
) + " FROM object_io GROUP BY ALL)"


def table_io(t):
    rows = t.snapshot("object_io")
    sums = [c for c in rows.columns if c.startswith(("count_", "sum_"))]
    return rows.groupBy(*n.POLL, "object_schema", "object_name").agg(
        *[F.sum(s).alias(s) for s in sums]
    )


@query(
    "norm_table_io",
    flat_sql(
        "mysql.table_io", {"schema": "object_schema", "table": "object_name"},
        _io("fetch", "insert", "update", "delete"),
        ranked(_TABLE_IO, f"object_schema {_NOT_SYSTEM} AND count_star > 0",
               "sum_timer_wait DESC, object_schema, object_name"),
        "place <= 30",
    ),
)
def _norm_table_io(t):
    return flat(n.norm_table_io(table_io(t), 30))


@query(
    "norm_index_io",
    flat_sql(
        "mysql.index_io",
        {"schema": "object_schema", "table": "object_name", "index": "index_name"},
        _io("fetch"),
        ranked("object_io", f"object_schema {_NOT_SYSTEM} AND index_name IS NOT NULL "
               "AND count_star > 0", "sum_timer_wait DESC, object_schema, object_name, index_name"),
        "place <= 30",
    ),
)
def _norm_index_io(t):
    return flat(n.norm_index_io(t.snapshot("object_io"), 30))


@query(
    "norm_status_legacy",
    f"""
    SELECT observed_at AS ts, run_id, host, tier, 'global_status' AS source,
           variable_name AS metric, {r(_FLOAT, 'value')}
    FROM status WHERE {_STATUS}
    """,
)
def _norm_status_legacy(t):
    return n.norm_status_legacy(t.snapshot("status"))


_LEGACY = ", ".join(
    "{" + f"'name': '{name}', 'number': CAST(coalesce({e}, 0) AS DOUBLE)" + "}"
    for name, e in (
        ("count", "count_star"), ("latency_ms", "sum_timer_wait / 1e9"),
        ("lock_ms", "sum_lock_time / 1e9"), ("rows_examined", "sum_rows_examined"),
        ("rows_sent", "sum_rows_sent"), ("no_index_used", "sum_no_index_used"),
    )
)


@query(
    "norm_digest_legacy",
    f"""
    SELECT ts, run_id, host, tier, 'ps_digest' AS source,
           concat('digest.', substring(digest, 1, 16), '.', u.name) AS metric,
           {r('u.number', 'value')}
    FROM (SELECT observed_at AS ts, run_id, host, tier, digest, unnest([{_LEGACY}]) AS u
          FROM {ranked('digests', f'digest IS NOT NULL AND schema_name {_NOT_SYSTEM}',
                       _DIGEST_ORDER)} WHERE place <= 20)
    """,
)
def _norm_digest_legacy(t):
    return n.norm_digest_legacy(t.snapshot("digests"))


@query("norm_error_event", "SELECT * FROM log_events")
def _norm_error_event(t):
    return n.norm_error_event(t.error_log)


@query(
    "norm_health_point",
    flat_sql(
        "collector.health", {},
        {"heartbeat": ("float", "1"),
         "mysql_reachable": ("float", "CASE WHEN reachable THEN 1 ELSE 0 END")}, "cycles",
    ) + " UNION ALL " + flat_sql(
        "collector.health", {}, {"cycle_duration_ms": ("float", "duration_ms")}, "cycles",
        "duration_ms IS NOT NULL",
    ),
)
def _norm_health_point(t):
    return flat(n.norm_health_point(t.cycles))

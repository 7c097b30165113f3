"""Sources, sinks and streams.

A sink or stream writes below the shared scratch folder while the query is built; the returned
frame reads what it wrote. Where a stream must end at the batch result, the batch SQL checks it.
"""

from __future__ import annotations

from datetime import datetime
from functools import lru_cache, reduce
from math import ceil

from pyspark.sql import functions as F

from tidegauge.catalog import CATALOG
from tidegauge.operators import alerts, sketches
from tidegauge.operators import contract as c
from tidegauge.operators import rollups as batch_rollups
from tidegauge.operators.alerts import RULES
from tidegauge.plans.contract_queries import TABLES as CONTRACT
from tidegauge.plans.contract_queries import _NUMBER, _UNITS, _valid, wire_rows
from tidegauge.plans.fixtures import AS_OF, Tables, metric_rows, series_rows
from tidegauge.plans.platform_queries import _alert_sql
from tidegauge.plans.rate_queries import _ROLLUP
from tidegauge.plans.registry import field_is, query, r
from tidegauge.session import brief_shuffles, scratch_folder
from tidegauge.sources import error_log, jsonl, lifecycle, platform, replay, segments, snapshots
from tidegauge.streaming import ingest, levels, liveness, log_source, rates, rollups
from tidegauge.streaming.batches import run_available

# --- JSON Lines -----------------------------------------------------------------------------


#: Events whose rows one task makes, about; a series file then holds some 100,000 rows or more.
_EVENTS_A_TASK = 25_000


def _dealt(t) -> Tables:
    """The tables over the same events, dealt to as many tasks as their number asks for.

    An event becomes dozens of rows, and the given table may lie in one piece, which one task reads. The
    few rows are dealt, not the many.
    """
    pieces = max(t.spark.sparkContext.defaultParallelism, ceil(t.events.count() / _EVENTS_A_TASK))
    dealt = Tables(t.spark, t.folder)
    dealt.events = t.events.repartition(pieces)
    return dealt


def _round_trip(t, frame, reader):
    path = scratch_folder(t.spark, "jsonl")
    jsonl.write_jsonl(frame, path)
    return reader(t.spark, path)


@query(
    "read_telemetry_jsonl",
    """
    SELECT ts, 2 AS contract_version, run_id, target_id, host, '' AS resource_id, tier,
           '' AS collector_id, measurement, series_key, fields_text AS fields
    FROM keyed
    """,
    CONTRACT,
)
def _read_telemetry_jsonl(t):
    frame = _round_trip(t, c.packed_row(_valid(t)), jsonl.read_telemetry_jsonl)
    return frame.withColumn("fields", F.to_json("fields")).drop("tags")


@query(
    "read_series_jsonl",
    f"""
    SELECT ts, contract_version, run_id, target_id, host, tier, measurement, field,
           {r('value', 'value')}, series_key, nullif(tag_event, '') AS event, nullif(tag_mode, '') AS mode
    FROM series
    """,
)
def _read_series_jsonl(t):
    frame = _round_trip(t, _dealt(t).series, jsonl.read_series_jsonl)
    return frame.selectExpr("*", "tags['event'] AS event", "tags['mode'] AS mode").drop(
        "tags", "kind", "unit"
    )


@query(
    "read_metrics_jsonl",
    f"SELECT ts, run_id, host, tier, source, metric, {r('value', 'value')} FROM metrics",
)
def _read_metrics_jsonl(t):
    return _round_trip(t, t.metrics, jsonl.read_metrics_jsonl)


@query(
    "read_events_jsonl",
    "SELECT ts, run_id, CAST(NULL AS VARCHAR) AS target_id, host, tier, source, level, "
    "error_code, subsystem, message, CAST(NULL AS VARCHAR) AS collector_id FROM log_events",
)
def _read_events_jsonl(t):
    legacy = t.log_events.drop("target_id", "collector_id")
    return _round_trip(t, legacy, jsonl.read_events_jsonl)


def _wire_archive(t):
    """The wire rows, good and bad, as an archive."""
    path = scratch_folder(t.spark, "archive")
    text = wire_rows(t).drop("event_id", "observed_at")
    text.select(F.to_json(F.struct(*text.columns)).alias("value")).write.text(path)
    return path


_REJECTED = """
    SELECT problem, count(*) AS rows FROM checked WHERE problem IS NOT NULL GROUP BY problem
"""


@query("load_archive_rejects", _REJECTED, CONTRACT)
def _load_archive_rejects(t):
    _, _, rejects = jsonl.load_archive(t.spark, _wire_archive(t), strict=False)
    return rejects.groupBy("problem").agg(F.count(F.lit(1)).alias("rows"))


_SERIES_ROWS = f"""
    SELECT ts, 2 AS contract_version, run_id, target_id, host, tier, measurement, x AS field,
           {_NUMBER}, CASE measurement WHEN 'mysql.file_io' THEN 'counter' ELSE 'gauge' END AS kind,
           {_UNITS} AS unit, series_key
    FROM (SELECT *, unnest(names) AS x FROM keyed)
"""


@query("load_archive", _SERIES_ROWS, CONTRACT)
def _load_archive(t):
    _, series, _ = jsonl.load_archive(t.spark, _wire_archive(t), strict=False)
    return series.drop("tags")


@query(
    "write_telemetry_jsonl",
    "SELECT run_id, measurement, 2 * count(*) AS rows, count(DISTINCT series_key) AS series "
    "FROM keyed GROUP BY ALL",
    CONTRACT,
)
def _write_telemetry_jsonl(t):
    path = scratch_folder(t.spark, "append")
    points = _valid(t)
    jsonl.write_telemetry_jsonl(points, path)
    jsonl.write_telemetry_jsonl(points, path)
    return jsonl.read_telemetry_jsonl(t.spark, path).groupBy("run_id", "measurement").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("series_key").alias("series")
    )


# --- snapshots and platform tables ----------------------------------------------------------


#: The fixture has one table for both kinds of object waits.
_EXPORTED = {"table_io": "object_io", "index_io": "object_io"}
#: What is summed over each scan, as both engines read it.
_SCANNED = {
    "status": "sum(length(variable_value))", "files": "sum(sum_timer_wait {div} 1000000)",
    "digests": "sum(sum_timer_wait {div} 1000000)", "engine_metrics": "sum({quote}count{quote})",
    "variables": "sum(length(variable_value))", "sessions": "sum(length(state))",
    "tables": "sum(data_length)", "table_io": "sum(count_star)", "index_io": "sum(count_star)",
    "error_log": "sum(length(data))",
}


@query("scan_snapshots", " UNION ALL ".join(
    f"SELECT '{name}' AS name, count(*) AS rows, "
    f"CAST({total.format(div='//', quote=chr(34))} AS BIGINT) AS total "
    f"FROM {_EXPORTED.get(name, name)} WHERE {snapshots.SCANS[name][2]}"
    for name, total in _SCANNED.items()
))
def _scan_snapshots(t):
    parts = []
    for name, total in _SCANNED.items():
        path = scratch_folder(t.spark, name)
        exported = t.error_log if name == "error_log" else t.snapshot(_EXPORTED.get(name, name))
        exported.write.parquet(path)
        parts.append(snapshots.read_snapshot(t.spark, name, path).agg(
            F.count(F.lit(1)).alias("rows"),
            F.expr(f"CAST({total.format(div='div', quote='`')} AS BIGINT)").alias("total"),
        ).select(F.lit(name).alias("name"), "rows", "total"))
    return reduce(lambda a, b: a.union(b), parts)


@query(
    "scan_platform",
    f"""
    SELECT time_generated, metric_name, resource, {r('average', 'average')},
           {r('maximum', 'maximum')}, {r('total', 'total')}
    FROM platform_metrics
    """,
)
def _scan_platform(t):
    path = scratch_folder(t.spark, "platform")
    platform.write_platform(t.platform_metrics, "metrics", path)
    return platform.read_platform(t.spark, "metrics", path)


@query(
    "scan_diagnostics",
    f"""
    SELECT 'MySqlSlowLogs' AS category, time_generated, resource, db_s, sql_text_s,
           {r('query_time_d', 'query_time_d')}, CAST(NULL AS VARCHAR) AS user_s FROM slow_log
    UNION ALL
    SELECT 'MySqlAuditLogs', time_generated, resource, db_s, sql_text_s, CAST(NULL AS DOUBLE),
           user_s FROM audit_log
    """,
)
def _scan_diagnostics(t):
    path = scratch_folder(t.spark, "diagnostics")
    platform.write_platform(t.diagnostics, "diagnostics", path)
    return platform.read_platform(t.spark, "diagnostics", path).select(
        "category", "time_generated", "resource", "db_s", "sql_text_s", "query_time_d", "user_s"
    )


@query("scan_activity", "SELECT * FROM activity")
def _scan_activity(t):
    path = scratch_folder(t.spark, "activity")
    platform.write_platform(t.activity, "activity", path, "json")
    return platform.read_platform(t.spark, "activity", path, "json")


@query(
    "incremental_error_log",
    """
    SELECT logged, run_id, target_id, error_code, prio, subsystem, data FROM error_log
    WHERE logged > TIMESTAMP '2024-01-10'
      AND logged <= (SELECT max(logged) FROM (SELECT logged FROM error_log
                     WHERE logged > TIMESTAMP '2024-01-10' ORDER BY logged LIMIT 500))
    """,
)
def _incremental_error_log(t):
    batch, _ = error_log.poll(t.error_log, datetime(2024, 1, 10))
    return batch.select("logged", "run_id", "target_id", "error_code", "prio", "subsystem", "data")


@query(
    "drained_error_log",
    "SELECT logged, run_id, target_id, error_code, prio, subsystem, data FROM error_log "
    "WHERE logged > TIMESTAMP '2024-01-10'",
)
def _drained_error_log(t):
    rows = error_log.drain(t.error_log, datetime(2024, 1, 10))
    return rows.select("logged", "run_id", "target_id", "error_code", "prio", "subsystem", "data")


@query(
    "error_log_cold_start",
    "SELECT max(logged) AS cursor FROM error_log",
)
def _error_log_cold_start(t):
    return error_log.cold_start(t.error_log, AS_OF)


# --- segments -------------------------------------------------------------------------------

#: Segment number of an event; one in ten numbers gets a fault.
_SEGMENTS = 40


def _write_segments(t) -> str:
    """A file of lines per segment number. The last segment is a copy of another."""
    path = scratch_folder(t.spark, "segments")
    number = F.pmod(F.col("event_id"), F.lit(_SEGMENTS))
    row = F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "target_id", "value")
    table = F.when((number == 7) & (F.col("k") % 2 == 0), "events").otherwise("metrics")
    line = F.to_json(F.struct(table.alias("table"), F.lit("m").alias("mapping"), row.alias("row")))
    text = (
        F.when((number == 17) & (F.col("k") % 9 == 0), F.lit("{broken"))
        .when((number == 27) & (F.col("k") % 9 == 0),
              F.lit('{"table":"metrics","mapping":"m","row":5}'))
        .otherwise(line)
    )
    lines = t.events.select("event_id", number.alias("segment"), text.alias("value"))
    (
        lines.repartition("segment").sortWithinPartitions("segment", "event_id")
        .select("segment", "value").write.partitionBy("segment").text(path)
    )
    copy = lines.filter(F.col("segment") == 1).repartition(1).sortWithinPartitions("event_id")
    copy.select("value").write.text(f"{path}/segment=99")
    return path + "/*"


#: The segments the fixture breaks, told from the events in them.
_FAULTS = {
    "faults": """
        SELECT event_id % 40 AS segment, 'segment has a line that is no row' AS problem FROM ev
        WHERE event_id % 40 IN (17, 27) AND k % 9 = 0 GROUP BY ALL
        UNION ALL
        SELECT 7, 'segment mixes tables or mappings' FROM ev WHERE event_id % 40 = 7
        HAVING count(DISTINCT k % 2) = 2
    """
}
_GOOD = "event_id % 40 NOT IN (SELECT segment FROM faults)"


@query(
    "replay_segments",
    f"""
    SELECT CASE WHEN event_id % 40 = 7 AND k % 2 = 0 THEN 'events' ELSE 'metrics' END AS "table",
           target_id, CAST(sum(n) AS BIGINT) AS rows, {r('sum(value * n)', 'total')}
    FROM (SELECT *, CASE WHEN event_id % 40 = 1 THEN 2 ELSE 1 END AS n FROM ev WHERE {_GOOD})
    GROUP BY ALL
    """,
    _FAULTS,
)
def _replay_segments(t):
    rows, _ = segments.read_segments(t.spark, _write_segments(t))
    parsed = rows.withColumn("r", F.from_json("row", "target_id string, value double"))
    return parsed.groupBy("table", F.col("r.target_id").alias("target_id")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("r.value").alias("total")
    )


@query(
    "quarantined_segments",
    "SELECT problem, count(*) AS files FROM faults GROUP BY problem",
    _FAULTS,
)
def _quarantined_segments(t):
    _, bad = segments.read_segments(t.spark, _write_segments(t))
    return bad.groupBy("problem").agg(F.count(F.lit(1)).alias("files"))


#: Rows of each table as segments hold them, and what is wrong with some; one in seven or so.
_FAULTY = {
    "metrics": ("CAST(floor(value) AS BIGINT) % 7 = 0", "value", "'much'", "value expects a number, got STRING"),
    "events": ("error_code LIKE '%7'", "ts", "'yesterday'", "ts expects a time, got STRING"),
    "series": ("CAST(floor(value) AS BIGINT) % 7 = 0", "value", "true", "value expects a number, got BOOLEAN"),
    "points": ("series_key < '3'", "contract_version", "'two'", "contract_version expects an integer, got STRING"),
}


@lru_cache(maxsize=4)
def _replayed(t) -> str:
    """Segments of all four tables, some of tables nobody knows, replayed in one pass."""
    path, out = scratch_folder(t.spark, "typed-in"), scratch_folder(t.spark, "typed-out")
    names = {table: names for names in replay.WIRE_TABLES.items() for table in [names[1][0]]}
    t = _dealt(t)
    frames = {"metrics": t.metrics, "events": t.log_events, "series": t.series, "points": c.packed_row(_valid(t))}
    for table, frame in frames.items():
        faulty, column, wrong, _ = _FAULTY[table]
        wire, (_, mapping) = names[table]
        layout = replay.LAYOUTS[table]
        marked = frame.select(F.expr(faulty).alias("faulty"), *layout.fieldNames())
        text = c.wire_text([*layout.fieldNames()], {column: F.expr(wrong)})
        plain = c.wire_text([*layout.fieldNames()])
        # Each task writes files of its own, of bounded size: segments as they lie in a spool.
        jsonl.write_lines(marked.select(
            F.concat(F.lit(f'{{"table":"{wire}","mapping":"{mapping}","row":'),
                     F.when(F.col("faulty"), text).otherwise(plain), F.lit("}")).alias("value"),
        ), f"{path}/table={table}")
    jsonl.write_lines(t.log_events.select(
        F.lit('{"table":"Elsewhere","mapping":"m","row":{"ts":"2024-01-01T00:00:00Z"}}').alias("value")
    ), f"{path}/table=strange")
    replay.write_routed(replay.route(t.spark, f"{path}/*"), out)
    return out


@query("replay_metrics", f"SELECT ts, run_id, host, tier, source, metric, {r('value', 'value')} FROM metrics "
                         f"WHERE NOT ({_FAULTY['metrics'][0]})")
def _replay_metrics(t):
    return replay.read_routed(t.spark, _replayed(t), "metrics")


@query("replay_events", f"SELECT * FROM log_events WHERE NOT ({_FAULTY['events'][0]})")
def _replay_events(t):
    return replay.read_routed(t.spark, _replayed(t), "events")


@query("replay_series", f"""
    SELECT ts, contract_version, run_id, target_id, host, tier, measurement, field,
           {r('value', 'value')}, series_key, nullif(tag_event, '') AS event, nullif(tag_mode, '') AS mode
    FROM series WHERE NOT ({_FAULTY['series'][0]})
""")
def _replay_series(t):
    return replay.read_routed(t.spark, _replayed(t), "series").selectExpr(
        "*", "tags['event'] AS event", "tags['mode'] AS mode").drop("tags", "kind", "unit")


@query("replay_points", f"""
    SELECT ts, 2 AS contract_version, run_id, target_id, host, '' AS resource_id, tier,
           '' AS collector_id, measurement, series_key, array_to_string(list_transform(
               list_sort(json_keys(fields_text)), lambda k: concat(k, '=', json_extract(fields_text, concat('$.', k)))), ',') AS fields
    FROM keyed WHERE NOT ({_FAULTY['points'][0]})
""", CONTRACT)
def _replay_points(t):
    """Fields are compared by name: an object's fields have no order once they are typed."""
    named = F.transform(F.map_entries("fields"), lambda e: F.concat(e["key"], F.lit("="), F.to_json(e["value"])))
    return replay.read_routed(t.spark, _replayed(t), "points").withColumn(
        "fields", F.array_join(F.array_sort(named), ",")).drop("tags")


@query("replay_rejects", " UNION ALL ".join(
    f"SELECT '{table}' AS origin, '{reason}' AS reason, count(*) AS rows FROM {source} WHERE {faulty} HAVING count(*) > 0"
    for table, source in (("metrics", "metrics"), ("events", "log_events"), ("series", "series"), ("points", "keyed"))
    for faulty, _, _, reason in [_FAULTY[table]]
) + " UNION ALL SELECT 'strange', 'unknown table: Elsewhere', count(*) FROM log_events HAVING count(*) > 0", CONTRACT)
def _replay_rejects(t):
    names = {wire: table for wire, (table, _) in replay.WIRE_TABLES.items()}
    origin = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("table")]
    return replay.read_rejects(t.spark, _replayed(t)).groupBy(
        F.coalesce(origin, F.lit("strange")).alias("origin"), "reason"
    ).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "idempotent_load",
    f"""
    SELECT target_id, count(*) AS rows, {r('sum(value)', 'total')} FROM ev
    WHERE {_GOOD} GROUP BY target_id
    """,
    _FAULTS,
)
def _idempotent_load(t):
    """The same folder is loaded twice and holds a copy of a segment; each row counts once."""
    path = _write_segments(t)
    folder = scratch_folder(t.spark, "load")
    for _ in range(2):
        segments.idempotent_load(t.spark, path, f"{folder}/rows", f"{folder}/ledger")
    parsed = t.spark.read.parquet(f"{folder}/rows").withColumn(
        "r", F.from_json("row", "target_id string, value double")
    )
    return parsed.groupBy(F.col("r.target_id").alias("target_id")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("r.value").alias("total")
    )


@query(
    "partition_by_target",
    """
    SELECT coalesce(nullif(CASE WHEN k % 4 = 0 THEN '' WHEN k % 4 <> 1 THEN target_id END, ''),
                    nullif(CASE WHEN k % 8 = 0 THEN '' WHEN k % 8 <> 1 THEN host END, ''),
                    'legacy') AS owner, count(*) AS rows
    FROM ev GROUP BY ALL
    """,
)
def _partition_by_target(t):
    path = scratch_folder(t.spark, "owners")
    rows = t.events.selectExpr(
        "event_id",
        "CASE WHEN k % 4 = 0 THEN '' WHEN k % 4 <> 1 THEN target_id END AS target_id",
        "CASE WHEN k % 8 = 0 THEN '' WHEN k % 8 <> 1 THEN host END AS host",
    )
    segments.write_by_target(rows, path)
    stored = t.spark.read.schema("event_id long, owner string").json(path)
    return stored.groupBy("owner").agg(F.count(F.lit(1)).alias("rows"))


# --- rollup backfill ------------------------------------------------------------------------


@query("rollup_backfill", _ROLLUP)
def _rollup_backfill(t):
    """Two backfills of the whole history leave each day once."""
    path = scratch_folder(t.spark, "backfill")
    for _ in range(2):
        batch_rollups.backfill(t.metrics, path)
    return t.spark.read.parquet(path).drop("day")


# --- streams --------------------------------------------------------------------------------


#: Rows of one file that a stream is fed with, about.
_STREAMED_ROWS = 500_000


def _fed(t, frame, source: str, batches: int):
    """The frame, added to a folder in no order, as a stream of so many batches.

    A batch has the same number of files, which grows with the rows, so that no task meets a whole batch.
    """
    files = max(1, ceil(frame.count() / (batches * _STREAMED_ROWS)))
    with brief_shuffles(t.spark):
        frame.repartition(batches * files).write.mode("append").parquet(source)
    return t.spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", files).parquet(source)


def _streamed(t, frame, label: str, files: int = 6):
    """The frame as a stream of so many batches, and folders for its output."""
    stream = _fed(t, frame, scratch_folder(t.spark, f"{label}-in"), files)
    return stream, scratch_folder(t.spark, f"{label}-out"), scratch_folder(t.spark, f"{label}-log")


@query("stream_metrics_1m", _ROLLUP)
def _stream_metrics_1m(t):
    stream, out, log = _streamed(t, t.metrics, "rollup")
    run_available(rollups.metrics_stream(stream, out), log)
    return rollups.read_metrics_rollup(t.spark, out)


@query(
    "stream_events_1m",
    "SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS ts, run_id, host, tier, level, subsystem, "
    "count(*) AS events FROM log_events GROUP BY ALL",
)
def _stream_events_1m(t):
    stream, out, log = _streamed(t, t.log_events, "events")
    run_available(rollups.events_stream(stream, out), log)
    return rollups.read_events_rollup(t.spark, out)


#: Every counter of the catalog, for the checking SQL; the series table says it of each row.
_COUNTERS = " OR ".join(
    "({})".format(field_is(name, *[f.name for f in spec.fields if f.kind == "counter"]))
    for name, spec in CATALOG.items() if any(f.kind == "counter" for f in spec.fields)
)
_PAIRED = {"paired": f"""
    SELECT *, value - prev_value AS delta,
           (epoch_us(ts) // 1000 - epoch_us(prev_ts) // 1000) / 1000e0 AS seconds
    FROM (SELECT *, lag(ts) OVER w AS prev_ts, lag(value) OVER w AS prev_value
          FROM series WHERE {_COUNTERS}
          WINDOW w AS (PARTITION BY run_id, target_id, measurement, field, series_key ORDER BY ts, value))
"""}
_ALL_RATES = f"""
    SELECT ts, run_id, target_id, host, tier, measurement, field, series_key,
           {r('delta', 'delta')}, {r('seconds', 'seconds')}, {r('delta / seconds', 'rate')}
    FROM paired WHERE seconds > 0 AND delta >= 0
"""


def _counter_samples(t):
    return _dealt(t).series.filter(F.col("kind") == "counter").select(*rates._COLUMNS)


@query("stream_series_rate", _ALL_RATES, _PAIRED)
def _stream_series_rate(t):
    """Files hold the samples in no order; a delay of the whole month keeps none of them late."""
    files = 4
    stream, out, log = _streamed(t, _counter_samples(t), "rates", files)
    run_available(rates.rate_stream(stream, out, delay_seconds=31 * 86400), log)
    done = rates.emitted_rates(t.spark, out)
    return done.unionByName(rates.open_rates(t.spark, out, files - 1))


@query("stream_late_rates", _ALL_RATES, _PAIRED)
def _stream_late_rates(t):
    """A short delay makes many samples late; counted again, the rates are those of the batch."""
    files = 3
    stream, out, log = _streamed(t, _counter_samples(t), "late", files)
    run_available(rates.rate_stream(stream, out, delay_seconds=3600), log)
    return rates.current_rates(t.spark, out, files - 1)


@query("stream_metric_alerts", _alert_sql(RULES))
def _stream_metric_alerts(t):
    stream, out, log = _streamed(t, t.platform_metrics, "alerts", 3)
    run_available(rollups.alert_stream(stream, out), log)
    return rollups.current_alerts(t.spark, out)


_STEPS = " ".join(f"WHEN '{rule.name}' THEN {rule.every_minutes}" for rule in RULES)
_ALERT_HISTORY = f"""
    SELECT rule, severity, resource, min(window_end) AS fired_at,
           max(window_end) + max(step) * INTERVAL 1 MINUTE AS resolved_at, count(*) AS windows
    FROM (SELECT *, sum(opens) OVER (PARTITION BY rule, resource ORDER BY window_start) AS run
          FROM (SELECT *, CASE WHEN lag(window_start) OVER (PARTITION BY rule, resource ORDER BY window_start)
                                    >= window_start - step * INTERVAL 1 MINUTE THEN 0 ELSE 1 END AS opens
                FROM (SELECT *, CASE rule {_STEPS} END AS step FROM ({_alert_sql(RULES)}))))
    GROUP BY rule, severity, resource, run
"""


@query("alert_history", _ALERT_HISTORY)
def _alert_history(t):
    return alerts.alert_history(alerts.metric_alerts(t.platform_metrics))


@query("stream_alert_history", _ALERT_HISTORY)
def _stream_alert_history(t):
    """When alerts fired and resolved, by the windows as the stream last judged them."""
    stream, out, log = _streamed(t, t.platform_metrics, "alerts", 3)
    run_available(rollups.alert_stream(stream, out), log)
    return alerts.alert_history(rollups.current_alerts(t.spark, out))


@query("stream_write_points", _SERIES_ROWS, CONTRACT)
def _stream_write_points(t):
    stream, out, log = _streamed(t, _wire_points(t), "points", 3)
    run_available(ingest.point_stream(stream, out), log)
    return levels.read_table(t.spark, f"{out}/series").drop("tags", "day")


@query(
    "stream_packed_points",
    """
    SELECT ts, 2 AS contract_version, run_id, target_id, host, '' AS resource_id, tier,
           '' AS collector_id, measurement, series_key, fields_text AS fields
    FROM keyed
    """,
    CONTRACT,
)
def _stream_packed_points(t):
    """The packed table as the stream left it, read back."""
    stream, out, log = _streamed(t, _wire_points(t), "points", 3)
    run_available(ingest.point_stream(stream, out), log)
    return levels.read_table(t.spark, f"{out}/points").withColumn("fields", F.to_json("fields")).drop("tags", "day")


@query("stream_point_rejects", _REJECTED, CONTRACT)
def _stream_point_rejects(t):
    stream, out, log = _streamed(t, _wire_points(t), "points", 3)
    run_available(ingest.point_stream(stream, out), log)
    return levels.read_table(t.spark, f"{out}/rejects", schema=ingest.POINT_REJECTS).groupBy("problem").agg(
        F.count(F.lit(1)).alias("rows")
    )


def _wire_points(t):
    """Points with their faults; a naive time, which a parsed column cannot show, is null."""
    return c.point_from_row(wire_rows(t)).drop("event_id", "observed_at")


@query("stream_archive", _REJECTED, CONTRACT)
def _stream_archive(t):
    path, out = _wire_archive(t), scratch_folder(t.spark, "follow-out")
    run_available(ingest.archive_stream(t.spark, path, out), scratch_folder(t.spark, "follow-log"))
    return levels.read_table(t.spark, f"{out}/rejects", schema=ingest.LINE_REJECTS).groupBy("problem").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query("stream_error_log", "SELECT * FROM log_events")
def _stream_error_log(t):
    stream, out, log = _streamed(t, t.error_log, "errors", 4)
    run_available(ingest.error_log_stream(stream, out), log)
    return levels.read_table(t.spark, f"{out}/events").drop("day")


@query("polled_error_log", "SELECT * FROM log_events WHERE ts > TIMESTAMP '2024-01-10'")
def _polled_error_log(t):
    """The log in polls of at most 500 rows and whole ties, up to 40 a batch; a second run goes on at the
    stored cursor."""
    source, out, log = (scratch_folder(t.spark, f"polled-{x}") for x in ("in", "out", "log"))
    earlier = F.col("logged") < F.lit(datetime(2024, 1, 20)).cast("timestamp")
    for part in (earlier, ~earlier):
        t.error_log.filter(part).write.mode("append").parquet(source)
        stream = log_source.follow(t.spark, source, t.error_log.schema, begin=datetime(2024, 1, 10), polls=40)
        log_source.drain(ingest.error_log_stream(stream, out), log)
    return levels.read_table(t.spark, f"{out}/events").drop("day")


@query("merged_rollup", _ROLLUP)
def _merged_rollup(t):
    """A rollup that streams, is merged, and streams on: its days keep few folders, its rows all samples."""
    out, log = scratch_folder(t.spark, "merged-out"), scratch_folder(t.spark, "merged-log")
    source = scratch_folder(t.spark, "merged-in")
    parts = t.metrics.withColumn("part", F.pmod(F.xxhash64("ts", "metric"), F.lit(7)))
    for begin, end in ((0, 4), (4, 7)):
        some = parts.filter((F.col("part") >= begin) & (F.col("part") < end)).drop("part")
        stream = _fed(t, some, source, end - begin)
        run_available(rollups.metrics_stream(stream, out, fanout=3), log)
        levels.merge(t.spark, out, combine=rollups.combined_metrics, fanout=2)
    return rollups.read_metrics_rollup(t.spark, out)


def _rank_within(name: str, share: float) -> list:
    """Whether the exact rank of an approximate quantile is as near as the sketch promises."""
    below, upto = F.avg((F.col("value") < F.col(name)).cast("int")), F.avg((F.col("value") <= F.col(name)).cast("int"))
    return ((below - sketches.RANK_ERROR <= share) & (upto + sketches.RANK_ERROR >= share)).alias(f"{name}_within")


@query(
    "sketch_quantiles",
    """
    SELECT metric_name, resource, date_trunc('day', time_generated) AS ts, count(*) AS samples,
           min(maximum) AS min, max(maximum) AS max, true AS p50_within, true AS p95_within, true AS p99_within
    FROM platform_metrics GROUP BY ALL
    """,
)
def _sketch_quantiles(t):
    """Stored sketches of five minutes, merged to days, held against the exact ranks of their answers."""
    keys, shares = ["metric_name", "resource"], {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    table = scratch_folder(t.spark, "sketches")
    rows = t.platform_metrics.select(*keys, F.col("time_generated").alias("ts"), F.col("maximum").alias("value"))
    for number in range(2):  # bins of both batches meet when they are read
        part = rows.filter(F.pmod(F.xxhash64("ts", "value"), F.lit(2)) == number)
        levels.add_batch(sketches.sketched(part, keys, F.col("value")), table, number)
    daily = sketches.answers(sketches.merged(levels.read_table(t.spark, table), keys, 86400), shares)
    exact = rows.withColumn("ts", F.date_trunc("day", "ts"))
    # A row per key and day is sent to the samples. Spark takes these, made many by exploding, for the smaller side.
    return exact.join(F.broadcast(daily), [*keys, "ts"]).groupBy(*keys, "ts", "samples", "min", "max").agg(
        *[_rank_within(name, share) for name, share in shares.items()])


@query(
    "sketch_distinct",
    """
    SELECT measurement, CAST(NULL AS TIMESTAMP) AS ts, count(*) AS samples, true AS within FROM series GROUP BY measurement
    UNION ALL
    SELECT measurement, date_trunc('day', ts), count(*), true FROM series GROUP BY ALL
    """,
)
def _sketch_distinct(t):
    """Series counted by stored sketches of an hour, per day and over all, held against exact counts."""
    table = scratch_folder(t.spark, "distinct")
    name = F.concat_ws("|", "run_id", "target_id", "field", "series_key", F.date_format("ts", "yyyy-MM-dd HH"))
    rows = t.series.select("measurement", "ts", name.alias("name"))
    levels.add_batch(sketches.sketched(rows, ["measurement"], counted=F.col("name"), seconds=3600), table, 0)
    stored = levels.read_table(t.spark, table)
    parts = []
    for seconds in (None, 86400):
        told = sketches.answers(sketches.merged(stored, ["measurement"], seconds))
        by = ["measurement"] if seconds is None else ["measurement", "ts"]
        exact = rows.withColumn("ts", F.date_trunc("day", "ts")).groupBy(*by).agg(F.count_distinct("name").alias("exact"))
        off = F.abs(F.col("distinct_values") - F.col("exact"))
        parts.append(told.join(exact, by).select(
            "measurement", F.col("ts") if seconds else F.lit(None).cast("timestamp").alias("ts"), "samples",
            (off <= F.greatest(F.lit(1), sketches.DISTINCT_ERROR * F.col("exact"))).alias("within"),
        ))
    return parts[0].unionByName(parts[1])


#: A time at which the first ten days of the fixture are past the lifecycle.
_LATER = datetime(2024, 4, 10)
_KEPT = "ts >= TIMESTAMP '2024-01-11'"


@query(
    "expired_tables",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows, min(ts) AS oldest, max(ts) AS newest "
        f"FROM ({source.strip()}) WHERE {_KEPT}"
        for name, source in (
            ("points", "SELECT * FROM keyed"), ("series", "SELECT * FROM series"), ("metrics", "SELECT * FROM metrics"),
            ("events", "SELECT * FROM log_events"), ("metrics_1m", _ROLLUP),
            ("events_1m", "SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS ts FROM log_events "
                          "GROUP BY time_bucket(INTERVAL 1 MINUTE, ts), run_id, host, tier, level, subsystem"),
        )
    ),
    CONTRACT,
)
def _expired_tables(t):
    """All tables are filled, the days past the lifecycle dropped, and the rest read."""
    folder = scratch_folder(t.spark, "lifecycle")
    filled = {
        "points": (c.packed_row(_valid(t)), {}),
        "series": (t.events, {"expand": series_rows}), "metrics": (t.events, {"expand": metric_rows}),
        "events": (t.log_events, {}),
        "metrics_1m": (batch_rollups.metrics_partials(t.metrics), {"combine": rollups.combined_metrics}),
        "events_1m": (batch_rollups.events_rollup(t.log_events), {"combine": rollups.combined_events}),
    }
    for name, (rows, how) in filled.items():
        levels.add_batch(rows, f"{folder}/{name}", 0, **how)
    lifecycle.expire_tables(t.spark, folder, _LATER)
    merged = {
        "metrics_1m": lambda rows: batch_rollups.merge_partials(rows),
        "events_1m": lambda rows: rows,
    }
    parts = []
    for name in lifecycle.TABLES:
        rows = lifecycle.read_current(t.spark, folder, name, _LATER)
        parts.append(merged.get(name, lambda rows: rows)(rows).agg(
            F.count(F.lit(1)).alias("rows"), F.min("ts").alias("oldest"), F.max("ts").alias("newest")
        ).select(F.lit(name).alias("table_name"), "rows", "oldest", "newest"))
    return reduce(lambda a, b: a.unionByName(b), parts)


_OUTAGES = """
    SELECT target_id, host, run_id, min(ts) AS first_beat, max(ts) AS last_beat,
           count(*) AS beats, max(ts) + INTERVAL 60 SECOND AS down_at
    FROM (SELECT *, sum(starts) OVER (PARTITION BY target_id, host, run_id ORDER BY ts) AS session
          FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY target_id, host, run_id
                                    ORDER BY ts) <= INTERVAL 60 SECOND THEN 0 ELSE 1 END AS starts
                FROM series WHERE measurement = 'collector.health' AND field = 'heartbeat'))
    GROUP BY target_id, host, run_id, session
"""


@query("outages", _OUTAGES)
def _outages(t):
    return liveness.outages(t.series)


#: Rounds of delivery, and the seconds of one; the fixture's beats span thirty days.
_ROUNDS, _ROUND = 4, 8 * 86400
_BEATS_FROM = datetime(2024, 1, 1)


@query(
    "stream_liveness",
    _OUTAGES.replace("AND field = 'heartbeat'", f"""AND field = 'heartbeat'
        AND NOT (hash_late = 0 AND epoch(ts) % {_ROUND} < {_ROUND} - 86400 AND epoch(ts) < epoch(TIMESTAMP '2024-01-25'))"""
    ).replace("FROM series WHERE", "FROM (SELECT *, (epoch_us(ts) // 1000000) % 97 AS hash_late FROM series) WHERE"),
)
def _stream_liveness(t):
    """Beats from many files, some a little late, some so late that their silence was already told, then
    nothing but the clock: every session is told in the end, without the beats that came too late."""
    beats = t.measurement("collector.health").drop("tags")
    seconds = F.unix_seconds("ts")
    own = F.floor(seconds / _ROUND)
    first = int(_BEATS_FROM.timestamp()) // _ROUND
    into = F.pmod(seconds, F.lit(_ROUND))
    too_late = (F.pmod(seconds, F.lit(97)) == 0) & (into < _ROUND - 86400) & (F.col("ts") < F.lit(datetime(2024, 1, 25)))
    a_little = into >= _ROUND - 5  # within the delay of ten seconds
    dealt = beats.withColumn("round", (own - first + (too_late | a_little).cast("long")).cast("int"))
    source, ticks = scratch_folder(t.spark, "beats-in"), scratch_folder(t.spark, "ticks-in")
    out, log = scratch_folder(t.spark, "beats-out"), scratch_folder(t.spark, "beats-log")
    for number in range(_ROUNDS + 2):
        rows = dealt.filter((F.col("round") == number) if number else (F.col("round") <= 0)).drop("round")
        rows.repartition(4).write.mode("append").parquet(source)
        until = (first + number + 1) * _ROUND
        t.spark.range(until - 600, until + 1, 10).select(F.timestamp_seconds("id").alias("ts")).write.mode(
            "append").parquet(ticks)
        found = liveness.outages(
            t.spark.readStream.schema(beats.schema).parquet(source),
            ticks=t.spark.readStream.schema("ts timestamp").parquet(ticks),
        )
        run_available(found.writeStream.format("parquet").option("path", out), log)
    return t.spark.read.parquet(out)


@query("stream_sessions", _OUTAGES)
def _stream_sessions(t):
    """Beats in several files, in no order: late ones count like all others."""
    stream, out, log = _streamed(t, t.measurement("collector.health").drop("tags"), "sessions", 4)
    run_available(liveness.session_stream(stream, out), log)
    return liveness.current_outages(t.spark, out)

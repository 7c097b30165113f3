import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import contract as c
from tidegauge.operators import normalize as n

POLL = ("prod", "orders-db", "h", "v2", "", "collector-01", datetime(2024, 1, 1))
CONTEXT = ("run_id string, target_id string, host string, tier string, resource_id string, "
           "collector_id string, observed_at timestamp")


def snapshot(spark, columns, *rows):
    return spark.createDataFrame([(*POLL, *row) for row in rows], f"{CONTEXT}, {columns}")


def points(frame):
    valid, rejected = c.split_points(frame)
    assert rejected.count() == 0
    rows = valid.select("measurement", "tags", F.to_json("fields").alias("fields")).collect()
    return [(r["measurement"], dict(r["tags"]), json.loads(r["fields"])) for r in rows]


def test_status_keeps_the_allowed_numeric_names(spark):
    frame = snapshot(
        spark, "variable_name string, variable_value string", ("Queries", "42"),
        ("Threads_running", "3"), ("Not_listed", "9"), ("Slow_queries", "OFF"),
        ("Uptime", None),
    )
    assert points(n.norm_global_status(frame)) == [
        ("mysql.global_status", {}, {"Queries": 42.0, "Threads_running": 3.0})
    ]
    legacy = n.norm_status_legacy(frame).collect()
    assert {(r["metric"], r["value"], r["source"]) for r in legacy} == {
        ("Queries", 42.0, "global_status"), ("Threads_running", 3.0, "global_status"),
    }


def test_no_numeric_status_gives_no_point(spark):
    frame = snapshot(spark, "variable_name string, variable_value string", ("Queries", "x"))
    assert points(n.norm_global_status(frame)) == []


FILE = ("event_name string, count_star long, sum_timer_wait long, count_read long, "
        "sum_number_of_bytes_read long, sum_timer_read long, count_write long, "
        "sum_number_of_bytes_write long, sum_timer_write long, count_misc long, "
        "sum_timer_misc long")


def test_file_row_becomes_three_modes(spark):
    frame = snapshot(
        spark, FILE, ("innodb_data_file", 3, 5, 2, 4096, 2 * 10**9, 1, 512, 5 * 10**8, None, 0),
        ("idle", 0, 9, 0, 0, 0, 0, 0, 0, 0, 0),
    )
    found = {t["mode"]: f for _, t, f in points(n.norm_file_io(frame))}
    assert found["read"] == {"operations_total": 2, "bytes_total": 4096, "wait_ms_total": 2.0}
    assert found["write"] == {"operations_total": 1, "bytes_total": 512, "wait_ms_total": 0.5}
    assert found["misc"] == {"operations_total": 0, "bytes_total": 0, "wait_ms_total": 0.0}


def test_top_k_is_per_poll_with_ties_by_name(spark):
    rows = [(f"f{i}", 1, 7 if i < 4 else 1, *([0] * 8)) for i in range(6)]
    frame = snapshot(spark, FILE, *rows)
    other = frame.withColumn("target_id", F.lit("other"))
    found = n.norm_file_io(frame.union(other), 3)
    assert {(r["target_id"], r["tags"]["event"]) for r in found.collect()} == {
        (t, f"f{i}") for t in ("orders-db", "other") for i in range(3)
    }


DIGEST = ("schema_name string, digest string, count_star long, sum_timer_wait long, "
          "sum_lock_time long, sum_rows_examined long, sum_rows_sent long, sum_errors long, "
          "sum_warnings long, sum_created_tmp_tables long, sum_created_tmp_disk_tables long, "
          "sum_no_index_used long, quantile_95 long, quantile_99 long")


def test_digest(spark):
    values = (3, 4 * 10**9, 10**9, 30, 2, 1, 2, 3, 1, 1, 2 * 10**9, 3 * 10**9)
    frame = snapshot(spark, DIGEST, ("app", "abc", *values), (None, "def", *([None] * 12)),
                     ("app", None, *values))
    found = {t["digest"]: (t["schema"], f) for _, t, f in points(n.norm_statement_digest(frame))}
    assert found["abc"][0] == "app"
    assert found["abc"][1]["latency_ms_total"] == 4.0 and found["abc"][1]["latency_p99_ms"] == 3.0
    assert found["abc"][1]["no_index_used_total"] == 1
    assert found["def"][0] == "(none)" and set(found["def"][1].values()) == {0}


def test_legacy_digest_names(spark):
    values = (3, 4 * 10**9, 10**9, 30, 2, 1, 2, 3, 1, 1, 2 * 10**9, 3 * 10**9)
    frame = snapshot(
        spark, DIGEST, ("app", "0123456789abcdefXYZ", *values), (None, "d2", *values),
        ("mysql", "d3", *values),
    )
    found = {r["metric"]: r["value"] for r in n.norm_digest_legacy(frame).collect()}
    prefix = "digest.0123456789abcdef."
    assert found == {
        prefix + "count": 3.0, prefix + "latency_ms": 4.0, prefix + "lock_ms": 1.0,
        prefix + "rows_examined": 30.0, prefix + "rows_sent": 2.0, prefix + "no_index_used": 1.0,
    }


def test_engine_metrics(spark):
    frame = snapshot(
        spark, "name string, subsystem string, type string, status string, count double",
        ("a", "s", "status_counter", "enabled", 10.0), ("b", "s", "value", "enabled", 100.5),
        ("c", "s", "counter", "disabled", 1.0), ("d", "s", "counter", "enabled", None),
    )
    assert {t["name"]: f for _, t, f in points(n.norm_innodb_metric(frame))} == {
        "a": {"counter_value": 10}, "b": {"gauge_value": 100.5}, "d": {"counter_value": 0},
    }


def test_variables(spark):
    frame = snapshot(
        spark, "variable_name string, variable_value string", ("max_connections", "151"),
        ("version", "8.4.4"), ("empty", ""),
    )
    assert {t["name"]: f for _, t, f in points(n.norm_global_variable(frame))} == {
        "max_connections": {"numeric_value": 151.0}, "version": {"text_value": "8.4.4"},
        "empty": {"text_value": ""},
    }


def test_sessions(spark):
    frame = snapshot(
        spark, "command string, state string, time long", ("Sleep", None, 20), ("Sleep", None, 5),
        ("Query", "sending", None),
    )
    assert sorted(map(str, points(n.norm_process_state(frame)))) == sorted(map(str, [
        ("mysql.process_state", {"command": "Sleep", "state": "(none)"},
         {"sessions": 2, "oldest_seconds": 20}),
        ("mysql.process_state", {"command": "Query", "state": "sending"},
         {"sessions": 1, "oldest_seconds": 0}),
    ]))


def test_schema_size(spark):
    frame = snapshot(
        spark,
        "table_schema string, table_name string, engine string, table_type string, "
        "table_rows long, data_length long, index_length long, data_free long",
        ("app", "orders", "InnoDB", "BASE TABLE", 10, 100, 20, 5),
        ("app", "v", "InnoDB", "VIEW", 1, 1, 1, 1), ("app", "x", None, "BASE TABLE", 1, 1, 1, 1),
        ("sys", "y", "InnoDB", "BASE TABLE", 1, 1, 1, 1),
    )
    assert points(n.norm_schema_size(frame)) == [
        ("mysql.schema_size", {"schema": "app", "table": "orders", "engine": "InnoDB"},
         {"rows_estimate": 10, "data_bytes": 100, "index_bytes": 20, "free_bytes": 5})
    ]


IO = ("object_schema string, object_name string, index_name string, count_star long, "
      "sum_timer_wait long, count_fetch long, sum_timer_fetch long, count_insert long, "
      "sum_timer_insert long, count_update long, sum_timer_update long, count_delete long, "
      "sum_timer_delete long")


def test_table_and_index_io(spark):
    frame = snapshot(
        spark, IO, ("app", "orders", "PRIMARY", 3, 3, 2, 2 * 10**9, 1, 10**9, 0, 0, 0, 0),
        ("app", "orders", None, 3, 3, 9, 9, 9, 9, 9, 9, 9, 9),
        ("mysql", "user", "PRIMARY", 3, 3, 9, 9, 9, 9, 9, 9, 9, 9),
    )
    assert points(n.norm_index_io(frame)) == [
        ("mysql.index_io", {"schema": "app", "table": "orders", "index": "PRIMARY"},
         {"fetch_total": 2, "fetch_wait_ms_total": 2.0})
    ]
    tables = points(n.norm_table_io(frame.filter("index_name = 'PRIMARY'")))
    assert tables[0][2]["insert_wait_ms_total"] == 1.0 and len(tables) == 1


@pytest.mark.parametrize("reachable,duration,fields", [
    (True, 12.5, {"heartbeat": 1.0, "mysql_reachable": 1.0, "cycle_duration_ms": 12.5}),
    (False, None, {"heartbeat": 1.0, "mysql_reachable": 0.0}),
])
def test_health_point(spark, reachable, duration, fields):
    frame = snapshot(spark, "reachable boolean, duration_ms double", (reachable, duration))
    assert points(n.norm_health_point(frame)) == [("collector.health", {}, fields)]

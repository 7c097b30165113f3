import json
from datetime import datetime, timedelta

import pytest

from tidegauge.operators import alerts, audits, health, platform
from tidegauge.sources import error_log, segments, snapshots, tables
from tidegauge.sources.platform import read_platform, write_platform

T0 = datetime(2024, 1, 1)


def segment(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    text = "".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)
    (folder / name).write_text(text)


def line(value, table="metrics", mapping="m"):
    return {"table": table, "mapping": mapping, "row": {"v": value}}


def test_good_and_bad_segments(spark, tmp_path):
    segment(tmp_path, "good.jsonl", line(1), line(2))
    segment(tmp_path, "broken.jsonl", line(3), "{nope")
    segment(tmp_path, "mixed.jsonl", line(4), line(5, table="events"))
    segment(tmp_path, "mapping.jsonl", line(4), line(5, mapping="other"))
    segment(tmp_path, "list.jsonl", {"table": "t", "mapping": "m", "row": [1]})
    segment(tmp_path, "empty.jsonl")
    rows, bad = segments.read_segments(spark, str(tmp_path))
    assert sorted(json.loads(r["row"])["v"] for r in rows.collect()) == [1, 2]
    assert {r["file"].split("/")[-1]: r["problem"] for r in bad.collect()} == {
        "broken.jsonl": "segment has a line that is no row",
        "mixed.jsonl": "segment mixes tables or mappings",
        "mapping.jsonl": "segment mixes tables or mappings",
        "list.jsonl": "segment has a line that is no row",
        "empty.jsonl": "segment is empty",
    }


def load(spark, tmp_path):
    segments.idempotent_load(
        spark, str(tmp_path / "in"), str(tmp_path / "rows"), str(tmp_path / "ledger")
    )
    rows = spark.read.parquet(str(tmp_path / "rows")).collect()
    return sorted(json.loads(r["row"])["v"] for r in rows)


def test_content_is_loaded_once(spark, tmp_path):
    segment(tmp_path / "in", "a.jsonl", line(1), line(2))
    segment(tmp_path / "in", "copy.jsonl", line(1), line(2))
    assert load(spark, tmp_path) == [1, 2]
    assert load(spark, tmp_path) == [1, 2]
    segment(tmp_path / "in", "b.jsonl", line(3))
    segment(tmp_path / "in", "renamed.jsonl", line(1), line(2))
    assert load(spark, tmp_path) == [1, 2, 3]


@pytest.mark.parametrize("written", [True, False])
@pytest.mark.parametrize("name", ["a.jsonl", "renamed.jsonl"])
def test_load_after_a_crash_between_its_writes(spark, tmp_path, written, name):
    """The ledger says begun; the rows may or may not have been written, the file renamed."""
    segment(tmp_path / "in", "a.jsonl", line(1), line(2))
    tag = segments.segment_tags(spark, str(tmp_path / "in")).first()
    begun = spark.createDataFrame(
        [(tag["tag"], tag["file"], "begun", "earlier")], segments.LEDGER
    )
    begun.write.parquet(str(tmp_path / "ledger"))
    if written:
        rows, _ = segments.read_segments(spark, str(tmp_path / "in"))
        rows.join(begun.select("tag", "file"), "file").write.parquet(str(tmp_path / "rows"))
    (tmp_path / "in" / "a.jsonl").rename(tmp_path / "in" / name)
    assert load(spark, tmp_path) == [1, 2]
    assert load(spark, tmp_path) == [1, 2]


def test_owner_falls_back_to_host(spark, tmp_path):
    rows = spark.createDataFrame(
        [("t", "h", 1), ("", "h", 2), (None, None, 3)], "target_id string, host string, n long"
    )
    segments.write_by_target(rows, str(tmp_path / "out"))
    stored = spark.read.json(str(tmp_path / "out"))
    assert {r["n"]: r["owner"] for r in stored.collect()} == {1: "t", 2: "h", 3: "legacy"}


def entries(spark, seconds):
    rows = [(T0 + timedelta(seconds=s), f"e{i}") for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "logged timestamp, data string")


def test_poll_keeps_ties_of_its_last_time(spark):
    log = entries(spark, [0, 1, 2, 2, 2, 3])
    batch, cursor = error_log.poll(log, T0, 2)
    assert batch.count() == 4 and cursor == T0 + timedelta(seconds=2)
    batch, cursor = error_log.poll(log, cursor, 2)
    assert [r["data"] for r in batch.collect()] == ["e5"]
    batch, again = error_log.poll(log, cursor, 2)
    assert batch.count() == 0 and again == cursor


def test_cold_start(spark):
    assert error_log.cold_cursor(entries(spark, [5, 9]), T0) == T0 + timedelta(seconds=9)
    assert error_log.cold_cursor(entries(spark, []).limit(0), T0) == T0


def test_jdbc_query_filters_at_the_server():
    text = snapshots.jdbc_query("table_io")
    assert "count_star > 0" in text and "'performance_schema'" in text
    assert "`variable_value`" in snapshots.jdbc_query("status")


def test_jdbc_query_is_cut_at_the_server():
    assert snapshots.jdbc_query("files", 7).endswith("ORDER BY sum_timer_wait DESC LIMIT 7")
    assert "ORDER BY data_length + index_length DESC LIMIT" in snapshots.jdbc_query("tables")
    assert "LIMIT" not in snapshots.jdbc_query("variables")


def test_drain_returns_what_polls_return(spark):
    log = entries(spark, [0, 1, 2, 2, 2, 3, 9])
    polled, cursor = [], T0
    while True:
        batch, after = error_log.poll(log, cursor, 2)
        if after == cursor:
            break
        polled += [r["data"] for r in batch.collect()]
        cursor = after
    assert sorted(polled) == sorted(r["data"] for r in error_log.drain(log, T0).collect())


def test_owners_of_packed_rows(spark, tmp_path):
    rows = spark.createDataFrame(
        [("t", "h", {"a": "b"}, 1), (None, "h", {}, 2)],
        "target_id string, host string, tags map<string, string>, n long",
    )
    segments.write_by_target(rows, str(tmp_path / "packed"))
    found = spark.read.json(str(tmp_path / "packed"))
    assert {r["n"]: r["owner"] for r in found.collect()} == {1: "t", 2: "h"}


def test_broken_lines_are_rejects_not_rows(spark, tmp_path):
    from tidegauge.schemas import METRICS
    from tidegauge.sources import jsonl

    (tmp_path / "m.jsonl").write_text(
        '{"ts": "2024-01-01T00:00:00Z", "run_id": "r", "host": "h", "metric": "m", "value": 1.5}\n'
        '{"ts": "no time", "run_id": "r2"}\n{broken\n[1, 2]\n\t\n'
    )
    rows = jsonl.read_metrics_jsonl(spark, str(tmp_path)).collect()
    assert [(r["run_id"], r["ts"] is None) for r in rows] == [("r", False), ("r2", True)]
    rejects = jsonl.read_rejects(spark, str(tmp_path), METRICS).collect()
    assert [r["value"] for r in rejects] == ["{broken", "[1, 2]"]
    assert jsonl.read_metrics_jsonl(spark, str(tmp_path)).count() == 2


def test_an_unreadable_ledger_is_an_error(spark, tmp_path):
    assert segments.read_ledger(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "ledger").mkdir()
    (tmp_path / "ledger" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        segments.read_ledger(spark, str(tmp_path / "ledger")).collect()


def test_platform_round_trip(spark, tmp_path):
    frame = spark.createDataFrame(
        [(T0, "cpu_percent", "s", 1.0, 2.0, 3.0)],
        "time_generated timestamp, metric_name string, resource string, average double, "
        "maximum double, total double",
    )
    for file_format in ("parquet", "json"):
        path = str(tmp_path / file_format)
        write_platform(frame, "metrics", path, file_format)
        assert read_platform(spark, "metrics", path, file_format).collect() == frame.collect()


def test_expired_days_are_dropped(spark):
    rows = [(T0 + timedelta(days=d), "m", "f", "k", float(d)) for d in (0, 5, 95)]
    series = spark.createDataFrame(
        rows, "ts timestamp, measurement string, field string, series_key string, value double"
    )
    tables.save_series(series, "kept_series")
    as_of = T0 + timedelta(days=95)
    current = tables.read_current(spark, "kept_series", as_of)
    assert sorted(r["value"] for r in current.collect()) == [5.0, 95.0]
    assert "PartitionFilters: [isnotnull(day" in current._jdf.queryExecution().toString()
    assert tables.drop_expired(spark, "kept_series", as_of) == 1
    assert spark.table("kept_series").count() == 2
    spark.sql("DROP TABLE kept_series")


# --- platform queries and alerts ------------------------------------------------------------


def test_failed_logins_list_ten_users(spark):
    rows = [(T0, "MySqlAuditLogs", "connection_log", "1.1.1.1", f"u{i % 15:02}", 1045.0)
            for i in range(60)]
    rows += [(T0, "MySqlAuditLogs", "connection_log", "1.1.1.1", "ok", 0.0),
             (T0, "MySqlAuditLogs", "general_log", "1.1.1.1", "x", 1045.0),
             (T0, "MySqlAuditLogs", "connection_log", "2.2.2.2", None, 1045.0)]
    log = spark.createDataFrame(
        rows, "time_generated timestamp, category string, event_class_s string, ip_s string, "
              "user_s string, error_code_d double",
    )
    found = platform.failed_logins(log, T0 + timedelta(hours=1)).collect()
    assert [(r["client_ip"], r["failures"]) for r in found] == [("1.1.1.1", 60), ("2.2.2.2", 1)]
    assert found[0]["users"] == [f"u{i:02}" for i in range(10)] and found[1]["users"] is None


def metric(spark, *rows):
    frame = [(T0 + timedelta(minutes=m), name, "s", float(v), float(v), float(v))
             for m, name, v in rows]
    return spark.createDataFrame(
        frame, "time_generated timestamp, metric_name string, resource string, average double, "
               "maximum double, total double",
    )


def test_sliding_average_needs_the_whole_window(spark):
    frame = metric(spark, (0, "cpu_percent", 100), (6, "cpu_percent", 80), (12, "cpu_percent", 80))
    fired = alerts.metric_alerts(frame).collect()
    assert {(r["window_start"], r["value"]) for r in fired} == {
        (T0 - timedelta(minutes=10), 100.0), (T0 - timedelta(minutes=5), 90.0),
        (T0, 260 / 3),
    }


def test_totals_add_up_inside_a_window(spark):
    frame = metric(spark, (0, "aborted_connections", 6), (1, "aborted_connections", 5),
                   (7, "aborted_connections", 10))
    fired = alerts.metric_alerts(frame).collect()
    assert [(r["rule"], r["value"], r["severity"]) for r in fired] == [
        ("mysql-aborted-connections", 11.0, 2)
    ]


def test_replication_lag_is_opt_in(spark):
    frame = metric(spark, (0, "replication_lag", 61))
    assert alerts.metric_alerts(frame).count() == 0
    assert alerts.replication_lag_alert(frame).count() == 3


# --- health ---------------------------------------------------------------------------------


def test_health_prefers_series_beats(spark):
    series = spark.createDataFrame(
        [(T0, "t", "h", "r", "collector.health", "heartbeat")],
        "ts timestamp, target_id string, host string, run_id string, measurement string, "
        "field string",
    )
    metrics = spark.createDataFrame(
        [(T0 + timedelta(seconds=50), "h", "r", "collector_heartbeat"),
         (T0 + timedelta(seconds=1), "old", "r", "collector_heartbeat")],
        "ts timestamp, host string, run_id string, metric string",
    )
    found = health.collector_health(series, metrics, T0 + timedelta(seconds=61))
    rows = {r["target_id"]: (r["seconds_since_last_beat"], r["status"]) for r in found.collect()}
    assert rows == {"t": (61, "DOWN"), "old": (60, "OK")}


def test_compliance(spark):
    rows = [("a", T0, "version", "8.0.1"), ("a", T0 + timedelta(1), "version", "8.4.9"),
            ("a", T0, "innodb_redo_log_capacity", "1"), ("a", T0, "require_secure_transport", "on"),
            ("b", T0, "version", "8.0.1")]
    frame = spark.createDataFrame(
        rows, "target_id string, observed_at timestamp, variable_name string, variable_value string"
    )
    found = {r["target_id"]: (r["version_ok"], r["redo_ok"], r["tls_ok"])
             for r in audits.server_compliance(frame).collect()}
    assert found == {"a": (True, True, True), "b": (False, False, False)}

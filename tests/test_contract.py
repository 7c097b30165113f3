import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidegauge.catalog import CATALOG
from tidegauge.functions.scalars import has_term, parse_double
from tidegauge.functions.tags import series_key
from tidegauge.functions.timing import utc_iso
from tidegauge.operators import contract as c
from tidegauge.sources import jsonl
from tidegauge.streaming import ingest, levels
from tidegauge.streaming.batches import run_available

GOOD = {
    "ts": "2024-01-01T00:00:00.5Z", "run_id": "prod", "target_id": "orders-db", "host": "h",
    "tier": "premium-ssd-v2", "measurement": "mysql.file_io",
    "tags": {"event": "innodb_data_file", "mode": "read"},
    "fields": {"operations_total": 10, "bytes_total": 4096, "wait_ms_total": 4.5},
}


def archive(tmp_path, *rows, name="a.jsonl"):
    text = "\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows)
    (tmp_path / name).write_text(text + "\n", encoding="utf-8")
    return str(tmp_path)


def problems(spark, tmp_path, *rows):
    _, _, rejects = jsonl.load_archive(spark, archive(tmp_path, *rows), strict=False)
    return [r["problem"] for r in rejects.collect()]


def changed(**changes):
    row = {**GOOD, **changes}
    return {k: v for k, v in row.items() if v is not ...}


def test_valid_row_loads(spark, tmp_path):
    packed, series, rejects = jsonl.load_archive(spark, archive(tmp_path, GOOD, "", "  "))
    assert packed.count() == 1 and rejects.count() == 0
    assert {(r["field"], r["value"], r["kind"], r["unit"]) for r in series.collect()} == {
        ("operations_total", 10.0, "counter", "operations"),
        ("bytes_total", 4096.0, "counter", "bytes"), ("wait_ms_total", 4.5, "counter", "ms"),
    }


@pytest.mark.parametrize("change,problem", [
    ({"fields": {**GOOD["fields"], "x": 1, "a": 2}}, "mysql.file_io: unknown fields: a, x"),
    ({"fields": {"operations_total": 1}},
     "mysql.file_io: missing fields: bytes_total, wait_ms_total"),
    ({"tags": {"mode": "read", "zone": "1"}},
     "mysql.file_io: unknown tags: zone; missing tags: event"),
    ({"fields": {**GOOD["fields"], "operations_total": True}},
     "mysql.file_io.operations_total expects int, got bool"),
    ({"fields": {**GOOD["fields"], "operations_total": 1.5}},
     "mysql.file_io.operations_total expects int, got float"),
    ({"fields": {**GOOD["fields"], "wait_ms_total": "slow"}},
     "mysql.file_io.wait_ms_total expects float, got str"),
    ({"fields": {**GOOD["fields"], "wait_ms_total": None}},
     "mysql.file_io.wait_ms_total expects float, got NoneType"),
    ({"measurement": "mysql.nope"}, "unknown measurement 'mysql.nope'"),
    ({"run_id": " ", "tier": ""}, "telemetry context requires: run_id, tier"),
    ({"ts": "2024-01-01T00:00:00"}, "observed_at must be timezone-aware"),
    ({"fields": {}}, "mysql.file_io must contain at least one field"),
    ({"fields": {"": 1}}, "mysql.file_io contains an empty field name"),
    ({"tags": {"": "x"}}, "mysql.file_io tags require non-empty names and values"),
    ({"host": ...}, "missing key: host"),
])
def test_rejects_with_reason(spark, tmp_path, change, problem):
    assert problems(spark, tmp_path, changed(**change), GOOD) == [problem]


def test_malformed_line(spark, tmp_path):
    assert problems(spark, tmp_path, "{nope", GOOD) == ["malformed JSON"]


def test_integers_pass_as_reals_and_huge_ones_as_integers(spark, tmp_path):
    fields = {**GOOD["fields"], "wait_ms_total": 4, "bytes_total": 10**20}
    assert problems(spark, tmp_path, changed(fields=fields)) == []


def test_strict_load_names_file_and_problem(spark, tmp_path):
    packed, _, _ = jsonl.load_archive(spark, archive(tmp_path, GOOD, changed(measurement="x")))
    with pytest.raises(Exception, match="a.jsonl: invalid telemetry row: unknown measurement"):
        packed.collect()


def test_empty_archive(spark, tmp_path):
    with pytest.raises(jsonl.ArchiveError):
        jsonl.load_archive(spark, archive(tmp_path, "", " "))


def test_append_keeps_earlier_rows(spark, tmp_path):
    packed, _, _ = jsonl.load_archive(spark, archive(tmp_path, GOOD))
    out = str(tmp_path / "out")
    jsonl.write_jsonl(packed, out)
    jsonl.write_jsonl(packed, out)
    again = jsonl.read_telemetry_jsonl(spark, out)
    assert again.count() == 2
    assert again.select("series_key").distinct().count() == 1
    assert again.first()["ts"] == datetime(2024, 1, 1, 0, 0, 0, 500000)
    line = json.loads(spark.read.text(out).first()["value"])
    assert line["ts"] == "2024-01-01T00:00:00.500000Z" and line["azure_resource_id"] == ""
    assert line["fields"] == GOOD["fields"] and line["contract_version"] == 2


@pytest.mark.parametrize("tags", [
    {}, {"mode": "read", "event": "x"}, {"event": "x", "mode": "read"}, {"a": "é \U0001f600"},
    {"a": 'q"\\/\n\t\r\b\f\x01\x7f', "Z": "", "ä": "1"},
])
def test_series_key_equals_hash_of_canonical_json(spark, tags):
    identity = {"target_id": "db-ü", "measurement": "mysql.file_io", "tags": tags}
    text = json.dumps(identity, sort_keys=True, separators=(",", ":"))
    expected = hashlib.sha256(text.encode()).hexdigest()[:24]
    frame = spark.createDataFrame(
        [("db-ü", "mysql.file_io", tags)], "target string, measurement string, tags map<string,string>"
    )
    key = series_key(F.col("target"), F.col("measurement"), F.col("tags"))
    assert frame.select(key.alias("k")).first()["k"] == expected


def test_tagged_point_has_no_legacy_form(spark, tmp_path):
    packed, _, _ = jsonl.load_archive(spark, archive(tmp_path, GOOD))
    with pytest.raises(Exception, match="cannot be represented by the legacy metric table"):
        c.legacy_metric_rows(packed, "collector").collect()


def test_legacy_form_is_checked_against_the_catalog(spark, tmp_path):
    packed, _, _ = jsonl.load_archive(spark, archive(tmp_path, GOOD))
    unknown = packed.withColumn("measurement", F.lit("no.such")).withColumn(
        "tags", F.map_filter("tags", lambda k, v: F.lit(False)))
    with pytest.raises(Exception, match="unknown measurement"):
        c.legacy_metric_rows(unknown, "collector").collect()


def test_context_of_white_space_is_blank(spark, tmp_path):
    _, _, rejects = jsonl.load_archive(spark, archive(tmp_path, changed(run_id="\t\u00a0")), strict=False)
    assert [r["problem"] for r in rejects.collect()] == ["telemetry context requires: run_id"]


def test_optional_text_field_stays_out_of_series(spark, tmp_path):
    row = changed(measurement="mysql.global_variable", tags={"name": "version"},
                  fields={"text_value": "8.4.4"})
    packed, series, _ = jsonl.load_archive(spark, archive(tmp_path, row))
    assert packed.count() == 1 and series.count() == 0


@pytest.mark.parametrize("text,value", [
    ("42", 42.0), (" 4.5 ", 4.5), ("1_000", 1000.0), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0),
    ("1d", None), ("1f", None), ("ON", None), ("", None), ("_1", None), ("1__0", None),
    ("0x10", None), ("-inf", float("-inf")), ("Infinity", float("inf")), (None, None),
])
def test_parse_double(spark, text, value):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(parse_double(F.col("t")).alias("v")).first()["v"] == value


@pytest.mark.parametrize("text,found", [
    ("x/RESTART/action", True), ("restarted", False), ("re-start", True), ("start_up", True),
    ("prestart", False), ("Stop", True),
])
def test_whole_terms(spark, text, found):
    frame = spark.createDataFrame([(text,)], "t string")
    term = has_term(F.col("t"), "restart", "failover", "start", "stop")
    assert frame.select(term.alias("v")).first()["v"] is found


def test_wire_time(spark):
    frame = spark.sql("SELECT TIMESTAMP '2024-02-03 04:05:06.000007' AS ts")
    assert frame.select(utc_iso(F.col("ts")).alias("v")).first()["v"] == "2024-02-03T04:05:06.000007Z"


def test_catalog_shape():
    assert len(CATALOG) == 10
    status = {f.name: f for f in CATALOG["mysql.global_status"].fields}
    assert len(status) == 86
    assert (status["Uptime"].kind, status["Uptime"].unit) == ("gauge", "s")
    assert status["Innodb_pages_read"].unit == "pages"
    assert status["Threads_running"].unit == "threads"
    assert status["Innodb_row_lock_time"].unit == "ms"
    assert status["Bytes_sent"].unit == "bytes" and status["Queries"].unit == "operations"


def test_an_archive_is_compressed_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jsonl, "ROWS_PER_FILE", 3)
    packed, _, _ = jsonl.load_archive(spark, archive(tmp_path, *[GOOD] * 10))
    out = tmp_path / "out"
    jsonl.write_jsonl(packed, str(out))
    files = [p for p in out.iterdir() if p.name.startswith("part-")]
    assert len(files) >= 4 and all(p.suffix == ".gz" for p in files)
    assert jsonl.read_telemetry_jsonl(spark, str(out)).count() == 10


def followed(spark, tmp_path, monkeypatch, name):
    """Rows that a call of ``ingest`` was given while an archive was followed, by its last text argument."""
    given, own = {}, getattr(ingest, name)

    def spy(rows, *others, **named):
        given["".join(x for x in others if isinstance(x, str)).rsplit("/", 1)[-1]] = rows.collect()
        own(rows, *others, **named)

    monkeypatch.setattr(ingest, name, spy)
    (tmp_path / "in").mkdir()
    path = archive(tmp_path / "in", GOOD, "{nope", changed(host=" "))
    run_available(ingest.archive_stream(spark, path, str(tmp_path / "out")), str(tmp_path / "log"))
    return given


def test_points_are_shuffled_before_they_become_series(spark, tmp_path, monkeypatch):
    given = followed(spark, tmp_path, monkeypatch, "add_batch")
    assert len(given["series"]) == 1 and "fields" in given["series"][0]
    found = levels.read_table(spark, str(tmp_path / "out" / "series"))
    assert sorted(r.field for r in found.collect()) == ["bytes_total", "operations_total", "wait_ms_total"]
    assert found.columns[-2:] == ["day", "measurement"]


def test_lines_of_valid_rows_are_not_kept(spark, tmp_path, monkeypatch):
    rows, = followed(spark, tmp_path, monkeypatch, "_add_points").values()
    assert sorted((r.problem is None, r.value) for r in rows if r.problem is None) == [(True, None)]
    found = levels.read_table(spark, str(tmp_path / "out" / "rejects"), schema=ingest.LINE_REJECTS).collect()
    assert sorted(r.value for r in found) == sorted(["{nope", json.dumps(changed(host=" "))])

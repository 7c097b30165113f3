"""Sketches in rollups, alert history, numbers as the wire has them, the log as a stream."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import alerts, contract, sketches
from tidegauge.sources import jsonl
from tidegauge.streaming import log_source

T0 = datetime(2024, 1, 1)


def test_merged_sketches_answer_like_all_values(spark):
    draw = random.Random(1)
    values = [draw.lognormvariate(0, 2) for _ in range(20_000)]
    rows = spark.createDataFrame(
        [(T0 + timedelta(seconds=i), "k", v, f"u{i % 3000}") for i, v in enumerate(values)],
        "ts timestamp, key string, value double, user string")
    rollup = sketches.sketched(rows, ["key"], F.col("value"), F.col("user"))
    assert rollup.count() == 67
    told = sketches.answers(sketches.merged(rollup, ["key"]), {"p10": 0.1, "p50": 0.5, "p99": 0.99}).first()
    assert (told.samples, told.valued, told.min, told.max) == (20_000, 20_000, min(values), max(values))
    for name, share in (("p10", 0.1), ("p50", 0.5), ("p99", 0.99)):
        rank = sum(v <= told[name] for v in values) / len(values)
        assert abs(rank - share) <= sketches.RANK_ERROR
    assert abs(told.distinct_values - 3000) <= 3000 * sketches.DISTINCT_ERROR
    hourly = sketches.merged(rollup, ["key"], 3600)
    assert hourly.count() == 6 and hourly.agg(F.sum("samples")).first()[0] == 20_000


def test_bins_without_values_and_partial_rows(spark):
    rows = spark.createDataFrame(
        [(T0, "a", None, None), (T0, "a", float("nan"), "x"), (T0 + timedelta(hours=1), "a", 5.0, "x"), (None, "a", 1.0, "y")],
        "ts timestamp, key string, value double, user string")
    rollup = sketches.sketched(rows, ["key"], F.col("value"), F.col("user"))
    told = {r.ts: r for r in sketches.answers(rollup, {"p50": 0.5}).collect()}
    assert (told[T0].samples, told[T0].valued, told[T0].p50, told[T0].distinct_values) == (2, 0, None, 1)
    assert told[None].p50 == 1.0
    again = sketches.answers(sketches.merged(rollup.union(rollup), ["key"], 300), {"p50": 0.5})
    assert {r.ts: r.samples for r in again.collect()} == {T0: 4, T0 + timedelta(hours=1): 2, None: 2}
    assert sketches.sketched(rows.limit(0), ["key"], F.col("value")).count() == 0


def fired(spark, starts, rule="mysql-cpu-high", resource="s"):
    size = {"mysql-cpu-high": 15, "mysql-storage-high": 15}[rule]
    return spark.createDataFrame([
        (rule, 2, resource, T0 + timedelta(minutes=m), T0 + timedelta(minutes=m + size), 90.0, 85.0) for m in starts
    ], "rule string, severity int, resource string, window_start timestamp, window_end timestamp, "
       "value double, threshold double")


def test_alerts_fire_and_resolve(spark):
    rows = fired(spark, [0, 5, 10, 20, 1435, 1440, 1445, 4000]).unionByName(
        fired(spark, [0, 5], resource="t")).unionByName(fired(spark, [0, 15, 45], "mysql-storage-high"))
    at = lambda m: T0 + timedelta(minutes=m)
    got = sorted((r.rule, r.resource, r.fired_at, r.resolved_at, r.windows) for r in alerts.alert_history(rows).collect())
    assert got == [
        ("mysql-cpu-high", "s", at(15), at(30), 3), ("mysql-cpu-high", "s", at(35), at(40), 1),
        ("mysql-cpu-high", "s", at(1450), at(1465), 3), ("mysql-cpu-high", "s", at(4015), at(4020), 1),
        ("mysql-cpu-high", "t", at(15), at(25), 2),
        ("mysql-storage-high", "s", at(15), at(45), 2), ("mysql-storage-high", "s", at(60), at(75), 1),
    ]
    assert alerts.alert_history(rows.limit(0)).count() == 0


LINE = ('{{"ts": "2024-01-01T00:00:00Z", "run_id": "r", "target_id": "t", "host": "h", "tier": "v", '
        '"measurement": "mysql.file_io", "tags": {{"event": "e", "mode": "m"}}, "fields": '
        '{{"operations_total": {}, "bytes_total": {}, "wait_ms_total": {}}}}}')


@pytest.mark.parametrize("number,problem", [
    ("12345678901234567890", None), ("12345678901234567890.0", "float"), ("-12345678901234567890.000", "float"),
    ("1234567890123456789.5", "float"), ("5", None), ("5.0", "float"), ("1e25", "float"),
    ('"12345678901234567890.0"', "str"),
])
def test_wide_real_numbers_are_real(spark, tmp_path, number, problem):
    (tmp_path / "a.jsonl").write_text(LINE.format(number, 1, 12.5) + "\n")
    lines = spark.read.text(str(tmp_path)).select("value", F.col("_metadata.file_path").alias("file"))
    row, = jsonl.parse_lines(lines).collect()
    want = problem and f"mysql.file_io.operations_total expects int, got {problem}"
    assert row.problem == want


def test_a_wide_real_is_a_number_where_one_may_stand(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(LINE.format(1, 2, "12345678901234567890.0") + "\n")
    packed, series, rejects = jsonl.load_archive(spark, str(tmp_path))
    assert {r.field: r.value for r in series.collect()}["wait_ms_total"] == 12345678901234567890.0
    assert rejects.count() == 0


def test_types_of_variants(spark):
    texts = {"1": "int", "1.5": "float", "true": "bool", '"x"': "str", "null": "NoneType", "[1]": "list", '{"a":1}': "dict",
             "9223372036854775808": "int"}
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", contract.value_type(F.parse_json("t")).alias("k"), contract.is_number(F.parse_json("t")).alias("n"))
    for r in rows.collect():
        assert r.k == texts[r.t] and r.n == (r.k in ("int", "float"))


LOG = "logged timestamp, data string"


def entries(spark, path, seconds, mark="a"):
    rows = [(T0 + timedelta(seconds=s), f"{mark}{i}") for i, s in enumerate(seconds)]
    spark.createDataFrame(rows, LOG).repartition(2).write.mode("append").parquet(str(path))


def polled(spark, tmp_path, rows, begin=T0, fail=None):
    schema = spark.createDataFrame([], LOG).schema
    stream = log_source.follow(spark, str(tmp_path / "in"), schema, rows, begin)
    seen = []

    def step(batch, batch_id):
        if fail == batch_id:
            raise RuntimeError("lost")
        seen.append((batch_id, sorted(r.data for r in batch.collect())))

    log_source.drain(stream.writeStream.foreachBatch(step), str(tmp_path / "log"))
    return seen


def test_polls_are_bounded_keep_ties_and_go_on_after_a_restart(spark, tmp_path):
    entries(spark, tmp_path / "in", [0, 1, 2, 3, 3, 3, 4, 5])
    assert polled(spark, tmp_path, 3) == [(0, ["a1", "a2", "a3", "a4", "a5"]), (1, ["a6", "a7"])]
    assert polled(spark, tmp_path, 3) == []
    entries(spark, tmp_path / "in", [4, 5, 6, 7, 8, 9], "b")  # the first two are behind the cursor
    assert polled(spark, tmp_path, 3) == [(2, ["b2", "b3", "b4"]), (3, ["b5"])]


def test_a_poll_that_failed_is_repeated(spark, tmp_path):
    entries(spark, tmp_path / "in", range(7))
    with pytest.raises(Exception, match="lost"):
        polled(spark, tmp_path, 2, fail=1)
    assert polled(spark, tmp_path, 2) == [(1, ["a3", "a4"]), (2, ["a5", "a6"])]


def test_without_a_beginning_only_newer_entries_are_read(spark, tmp_path):
    entries(spark, tmp_path / "in", [0, 5])
    assert [rows for _, rows in polled(spark, tmp_path, 10, begin=None) if rows] == []
    reader = log_source.LogReader(str(tmp_path / "in"), ["logged", "data"], 10, None)
    assert reader.initialOffset() == {"cursor": datetime(2024, 1, 1, 0, 0, 5, tzinfo=timezone.utc).isoformat()}
    found, end = reader.read({"cursor": T0.replace(tzinfo=timezone.utc).isoformat()})
    assert [r[1] for r in found] == ["a1"]
    assert list(reader.readBetweenOffsets({"cursor": end["cursor"]}, end)) == []


@pytest.mark.parametrize("polls", [1, 2, 3, 5, 100])
def test_polls_of_one_batch_end_where_single_ones_would(spark, tmp_path, polls):
    entries(spark, tmp_path / "in", [0, 1, 2, 3, 3, 3, 3, 3, 4, 5, 6, 6, 7, 8, 9])
    ends = []
    for number in (1, polls):
        reader = log_source.LogReader(str(tmp_path / "in"), ["logged", "data"], 3, None, number)
        cursor, found = {"cursor": T0.replace(tzinfo=timezone.utc).isoformat()}, []
        ends.append([])
        while (step := reader.read(cursor))[1] != cursor:
            cursor = step[1]
            found += [r[1] for r in step[0]]
            ends[-1].append(cursor["cursor"])
        assert sorted(found) == sorted(f"a{i}" for i in range(1, 15))
    assert set(ends[1]) <= set(ends[0]) and ends[1][-1] == ends[0][-1]
    assert len(ends[1]) <= len(ends[0]) and (polls < 100 or len(ends[1]) == 1)

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators.rates import metric_series_rate
from tidegauge.operators.rollups import metrics_rollup
from tidegauge.streaming import liveness, rates, rollups
from tidegauge.streaming.batches import read_batches, run_available

T0 = datetime(2024, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def stream(spark, path, schema):
    return spark.readStream.schema(schema).parquet(str(path))


def add(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


def sample(second, value, key="k"):
    return (at(second), "r", "t", "h", "v", "m", "f", key, float(value))


def feed(spark, tmp_path, rows, delay):
    add(spark, tmp_path / "in", rows, rates.SAMPLE)
    source = stream(spark, tmp_path / "in", rates.SAMPLE)
    run_available(rates.rate_stream(source, str(tmp_path / "out"), delay), str(tmp_path / "log"))


def emitted(spark, tmp_path):
    rows = rates.emitted_rates(spark, str(tmp_path / "out")).orderBy("ts").collect()
    return [(r["ts"], r["rate"]) for r in rows]


def test_out_of_order_sample_inside_the_delay(spark, tmp_path):
    feed(spark, tmp_path, [sample(0, 0), sample(20, 20), sample(100, 500)], 60)
    assert emitted(spark, tmp_path) == [(at(20), 1.0)]
    feed(spark, tmp_path, [sample(50, 80), sample(200, 600)], 60)
    assert emitted(spark, tmp_path) == [(at(20), 1.0), (at(50), 2.0), (at(100), 8.4)]
    rest = rates.open_rates(spark, str(tmp_path / "out"), 1).collect()
    assert [(r["ts"], r["rate"]) for r in rest] == [(at(200), 1.0)]


def test_sample_behind_the_watermark_is_kept_apart(spark, tmp_path):
    feed(spark, tmp_path, [sample(0, 0), sample(100, 100)], 10)
    feed(spark, tmp_path, [sample(50, 1), sample(200, 200)], 10)
    late = rates.late_samples(spark, str(tmp_path / "out")).collect()
    assert [r["ts"] for r in late] == [at(50)]
    assert emitted(spark, tmp_path) == [(at(100), 1.0)]


def test_stream_equals_batch(spark, tmp_path):
    rows = [sample(s * 7, (s * 37) % 1000 + s, f"k{s % 3}") for s in range(300)]
    for part in range(3):
        feed(spark, tmp_path, rows[part * 100:(part + 1) * 100], 30)
    done = rates.emitted_rates(spark, str(tmp_path / "out")).unionByName(
        rates.open_rates(spark, str(tmp_path / "out"), 2)
    )
    table = spark.createDataFrame(rows, rates.SAMPLE).withColumn(
        "tags", F.create_map().cast("map<string,string>")
    )
    batch = metric_series_rate(table, "m", "f", "r").drop("tags")
    assert sorted(map(str, done.select(*batch.columns).collect())) == sorted(
        map(str, batch.collect()))


def test_late_samples_are_rated_with_their_successors_only(spark, tmp_path):
    import random

    draw = random.Random(6)
    rows = [sample(s * 40, (s * 37) % 1000 + s, f"k{s % 3}") for s in range(900)]
    rows += [sample(s * 40, 5 + s, f"k{s % 3}") for s in range(0, 900, 60)]  # other values at the same instant
    late = [r for i, r in enumerate(rows) if i % 45 == 0 or draw.random() < 0.02 or 30_000 < (r[0] - T0).seconds < 30_200]
    rest = [r for r in rows if r not in late]
    for part in (rest, late[::2], late[1::2] + [sample(40_000, 1, "k0")]):
        feed(spark, tmp_path, part, 30)
    out = str(tmp_path / "out")
    everything = spark.createDataFrame(rows + [sample(40_000, 1, "k0")], rates.SAMPLE).withColumn(
        "tags", F.create_map().cast("map<string,string>"))
    batch = metric_series_rate(everything, "m", "f", "r").drop("tags")
    current = rates.current_rates(spark, out, 2)
    assert sorted(map(str, current.select(*batch.columns).collect())) == sorted(map(str, batch.collect()))

    told = rates.late_samples(spark, out)
    kept = rates.read_table(spark, f"{out}/samples").unionByName(
        rates.read_batch(spark, f"{out}/waiting", 2, rates.SAMPLE), allowMissingColumns=True)
    again = rates.near_late_samples(kept, rates._edges(kept, 3600), told).count()
    assert told.count() >= 40 and again <= 3 * told.count() < kept.count() / 4


def test_a_series_silent_for_the_lifecycle_begins_anew(spark, tmp_path):
    out = str(tmp_path / "out")
    for rows in ([sample(0, 0), sample(0, 0, "other")], [sample(91 * 86400, 5, "other")],
                 [sample(92 * 86400, 7, "other"), sample(92 * 86400, 9)], [sample(93 * 86400, 11)]):
        feed(spark, tmp_path, rows, 30)
    found = {(r.series_key, r.rate > 0) for r in rates.emitted_rates(spark, out).collect()}
    assert found == {("other", True)}
    assert {r.series_key for r in rates.read_batch(spark, f"{out}/tails", 3, rates.SAMPLE).collect()} == {"other", "k"}
    assert sorted(p.name for p in (tmp_path / "out" / "tails").iterdir()) == ["batch=2", "batch=3"]


METRIC = "ts timestamp, run_id string, host string, tier string, metric string, value double"


def test_late_rows_still_count_in_rollups(spark, tmp_path):
    parts = [[(at(5), "r", "h", "v", "m", 1.0), (at(3600), "r", "h", "v", "m", 9.0)],
             [(at(10), "r", "h", "v", "m", 3.0), (at(11), "r", "h", "v", "m", None)]]
    for rows in parts:
        add(spark, tmp_path / "in", rows, METRIC)
        run_available(
            rollups.metrics_stream(stream(spark, tmp_path / "in", METRIC), str(tmp_path / "out")),
            str(tmp_path / "log"),
        )
    merged = rollups.read_metrics_rollup(spark, str(tmp_path / "out"))
    batch = metrics_rollup(spark.createDataFrame(parts[0] + parts[1], METRIC))
    assert sorted(map(str, merged.select(*batch.columns).collect())) == sorted(
        map(str, batch.collect()))


def test_windowed_rollup_emits_closed_minutes(spark, tmp_path):
    rows = [(at(5), "r", "h", "v", "m", 1.0), (at(6), "r", "h", "v", "m", 3.0),
            (at(7200), "r", "h", "v", "m", 9.0)]
    add(spark, tmp_path / "in", rows, METRIC)
    closed = rollups.windowed_metrics(stream(spark, tmp_path / "in", METRIC), "60 seconds")
    run_available(
        closed.writeStream.format("parquet").option("path", str(tmp_path / "out")),
        str(tmp_path / "log"),
    )
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r["ts"], r["avg"], r["samples"]) for r in found] == [(T0, 2.0, 2)]


PLATFORM = ("time_generated timestamp, metric_name string, resource string, average double, "
            "maximum double, total double")


def test_alert_of_a_window_follows_later_rows(spark, tmp_path):
    def feed_metric(*rows):
        frame = [(T0 + timedelta(minutes=m), "cpu_percent", "s", v, v, v) for m, v in rows]
        add(spark, tmp_path / "in", frame, PLATFORM)
        source = stream(spark, tmp_path / "in", PLATFORM)
        run_available(rollups.alert_stream(source, str(tmp_path / "out")), str(tmp_path / "log"))
        return {r["window_start"]: r["value"]
                for r in rollups.all_alerts(spark, str(tmp_path / "out")).collect()}

    assert set(feed_metric((1, 90.0))) == {T0 - timedelta(minutes=m) for m in (0, 5, 10)}
    assert feed_metric((2, 84.0))[T0] == 87.0
    assert T0 not in feed_metric((8, 10.0))
    current = rollups.current_alerts(spark, str(tmp_path / "out"))
    truth = rollups.all_alerts(spark, str(tmp_path / "out"))
    assert sorted(current.collect()) == sorted(truth.select(current.columns).collect())
    assert {r["window_start"] for r in current.collect()} == {T0 - timedelta(minutes=10)}
    assert feed_metric((3, 1.0)) == {}
    assert rollups.current_alerts(spark, str(tmp_path / "out")).count() == 0


BEAT = ("ts timestamp, target_id string, host string, run_id string, measurement string, "
        "field string")


def test_silence_is_reported_once_and_a_minute_is_not_silence(spark, tmp_path):
    def beat(second, target="t"):
        return (at(second), target, "h", "r", "collector.health", "heartbeat")

    rows = [beat(0), beat(30), beat(90), beat(200), beat(500, "other")]
    add(spark, tmp_path / "in", rows, BEAT)
    source = stream(spark, tmp_path / "in", BEAT)
    run_available(
        liveness.outages(source).writeStream.format("parquet")
        .option("path", str(tmp_path / "out")),
        str(tmp_path / "log"),
    )
    found = spark.read.parquet(str(tmp_path / "out")).orderBy("last_beat").collect()
    assert [(r["target_id"], r["last_beat"], r["beats"], r["down_at"]) for r in found] == [
        ("t", at(90), 3, at(150)), ("t", at(200), 1, at(260)),
    ]


def test_ticks_tell_the_silence_of_all_collectors(spark, tmp_path):
    def beat(second, target):
        return (at(second), target, "h", "r", "collector.health", "heartbeat")

    def run(beats, ticks):
        add(spark, tmp_path / "in", beats, BEAT)
        add(spark, tmp_path / "ticks", [(at(s),) for s in ticks], "ts timestamp")
        found = liveness.outages(
            stream(spark, tmp_path / "in", BEAT), ticks=stream(spark, tmp_path / "ticks", "ts timestamp"))
        run_available(
            found.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "log"))
        rows = spark.read.parquet(str(tmp_path / "out")).collect()
        return sorted((r.target_id, r.beats, r.down_at) for r in rows)

    assert run([beat(0, "a"), beat(5, "b")], [5, 15]) == []
    assert run([beat(50, "a")], [55]) == []
    assert run([], [74]) == []  # the delay of ten seconds
    assert run([], [76]) == [("b", 1, at(65))]
    assert run([], [200]) == [("a", 2, at(110)), ("b", 1, at(65))]
    assert run([beat(20, "b")], [300]) == [("a", 2, at(110)), ("b", 1, at(65))]  # told before, too late


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    from tidegauge.streaming.batches import write_batch

    for _ in range(2):
        write_batch(spark.range(5), str(tmp_path / "t"), 0)
    write_batch(spark.range(2), str(tmp_path / "t"), 1)
    assert read_batches(spark, str(tmp_path / "t")).count() == 7


def test_a_late_beat_joins_its_sessions(spark, tmp_path):
    def beat(second):
        return (at(second), "t", "h", "r", "collector.health", "heartbeat")

    for rows in ([beat(0), beat(110), beat(400)], [beat(55)], [beat(30), beat(400)]):
        add(spark, tmp_path / "in", rows, BEAT)
        source = stream(spark, tmp_path / "in", BEAT)
        run_available(liveness.session_stream(source, str(tmp_path / "out")), str(tmp_path / "log"))
    found = liveness.current_outages(spark, str(tmp_path / "out")).orderBy("first_beat").collect()
    assert [(r["first_beat"], r["last_beat"], r["beats"], r["down_at"]) for r in found] == [
        (at(0), at(110), 4, at(170)), (at(400), at(400), 2, at(460)),
    ]


def test_a_batch_that_was_lost_is_an_error(spark, tmp_path):
    from tidegauge.streaming.batches import read_batch, write_batch

    assert read_batch(spark, str(tmp_path / "t"), -1, "id long").count() == 0
    write_batch(spark.range(3), str(tmp_path / "t"), 0)
    assert read_batch(spark, str(tmp_path / "t"), 0, "id long").count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_batch(spark, str(tmp_path / "t"), 1, "id long").count()


def shuffled(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {name for name in names if name.startswith("shuffle_")}


def test_a_rate_stream_leaves_no_shuffled_rows_on_disk(spark, tmp_path):
    before = shuffled(spark)
    feed(spark, tmp_path, [sample(s, s, f"k{s % 3}") for s in range(50)], 10)
    assert shuffled(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"

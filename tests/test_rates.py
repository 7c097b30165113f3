import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegauge.operators import rates
from tidegauge.operators.ordered import latest_before, with_previous

T0 = datetime(2024, 1, 1)
SERIES = (
    "ts timestamp, run_id string, target_id string, host string, tier string, measurement string, "
    "field string, series_key string, tags map<string,string>, value double"
)
METRICS = "ts timestamp, run_id string, host string, tier string, metric string, value double"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def series(spark, samples, key="k", run="r", target="t"):
    rows = [(at(s), run, target, "h", "v1", "m", "f", key, {"mode": "read"}, v) for s, v in samples]
    return spark.createDataFrame(rows, SERIES)


def rate(frame, start=0, end=10**7, run="r", **options):
    out = rates.metric_series_rate(frame, "m", "f", run, at(start), at(end), **options)
    return [(r["ts"], r["delta"], r["seconds"], r["rate"]) for r in out.orderBy("ts").collect()]


def test_first_sample_has_no_rate(spark):
    assert rate(series(spark, [(0, 5.0)])) == []


def test_plain_rate(spark):
    assert rate(series(spark, [(0, 5.0), (10, 25.0)])) == [(at(10), 20.0, 10.0, 2.0)]


def test_reset_is_dropped_and_next_sample_uses_it(spark):
    samples = [(0, 100.0), (10, 0.0), (20, 30.0)]
    assert rate(series(spark, samples)) == [(at(20), 30.0, 10.0, 3.0)]


def test_same_millisecond_duplicate_is_dropped(spark):
    samples = [(0, 1.0), (10, 11.0), (10.0004, 12.0), (20, 22.0)]
    assert [r[0] for r in rate(series(spark, samples))] == [at(10), at(20)]


def test_null_value_gives_no_rate_on_either_side(spark):
    samples = [(0, 1.0), (10, None), (20, 5.0), (30, 7.0)]
    assert [r[0] for r in rate(series(spark, samples))] == [at(30)]


def test_bounds_are_inclusive_and_apply_before_the_previous_sample(spark):
    samples = [(0, 0.0), (10, 10.0), (20, 20.0), (30, 30.0)]
    found = rate(series(spark, samples), start=10, end=20)
    assert [r[0] for r in found] == [at(20)]


def test_runs_sharing_a_series_key_stay_apart(spark):
    both = series(spark, [(0, 0.0), (20, 20.0)]).union(
        series(spark, [(10, 500.0), (30, 900.0)], run="other")
    )
    assert rate(both) == [(at(20), 20.0, 20.0, 1.0)]
    assert rate(both, run="other") == [(at(30), 400.0, 20.0, 20.0)]


def test_a_gap_of_many_empty_slices_still_finds_the_previous_sample(spark):
    samples = [(0, 0.0), (86400 * 40, 86400.0 * 40)]
    assert rate(series(spark, samples)) == [(at(86400 * 40), 86400.0 * 40, 86400.0 * 40, 1.0)]


@pytest.mark.parametrize("later,expected", [(2.1, [(2, 5.0)]), (0.95, [])])
def test_legacy_seconds_count_crossed_borders(spark, later, expected):
    rows = [(at(0.9), "r", "h", "v1", "m", 0.0), (at(later), "r", "h", "v1", "m", 10.0)]
    frame = spark.createDataFrame(rows, METRICS)
    found = rates.counter_rate(frame, "m", "r", at(0), at(100)).collect()
    assert [(2, r["rate"]) for r in found] == expected


def test_resets_are_the_complement(spark):
    frame = series(spark, [(0, 100.0), (10, 0.0), (20, 30.0), (5000, 1.0)])
    found = rates.counter_resets(frame, {"m": ["f"]}, ["r"]).orderBy("ts").collect()
    assert [(r["ts"], r["prev_value"], r["value"]) for r in found] == [
        (at(10), 100.0, 0.0), (at(5000), 30.0, 1.0),
    ]


def test_reset_explained_by_the_newest_earlier_restart(spark):
    resets = spark.createDataFrame(
        [(at(100), "h"), (at(90000), "h"), (at(50), "other")], "ts timestamp, host string"
    )
    marks = spark.createDataFrame(
        [(at(10), "h", "a"), (at(100), "h", "b"), (at(101), "h", "c")],
        "ts timestamp, host string, operation string",
    )
    found = {
        (r["host"], r["ts"]): (r["operation"], r["explained"])
        for r in rates.explain_resets(resets, marks, 60, slice_seconds=600).collect()
    }
    assert found == {
        ("h", at(100)): ("b", True), ("h", at(90000)): ("c", False), ("other", at(50)): (None, False),
    }


@pytest.mark.parametrize("slice_seconds", [7, 600, 10**7])
def test_slices_equal_one_window_with_a_hot_series(spark, slice_seconds):
    rng = random.Random(slice_seconds)
    rows = [
        ("hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}",
         at(rng.randrange(5000) + i / 10000), float(rng.randrange(100)))
        for i in range(2000)
    ]
    frame = spark.createDataFrame(rows, "key string, ts timestamp, value double")
    order = W.partitionBy("key").orderBy("ts", "value")
    plain = frame.select(
        "*", F.lag("ts").over(order).alias("prev_ts"), F.lag("value").over(order).alias("prev_value")
    )
    sliced = with_previous(frame, ["key"], slice_seconds=slice_seconds).drop("_slice")
    assert sorted(map(str, sliced.collect())) == sorted(map(str, plain.select(*sliced.columns).collect()))


def test_as_of_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), at(rng.randrange(3000)), i) for i in range(300)]
    marks = [(rng.choice("ab"), at(s), None if s % 3 else f"m{s}") for s in rng.sample(range(3000), 40)]
    left = spark.createDataFrame(rows, "key string, ts timestamp, n long")
    right = spark.createDataFrame(marks, "key string, ts timestamp, info string")
    found = {
        r["n"]: (r["mark_ts"], r["info"])
        for r in latest_before(left, right, ["key"], ["info"], slice_seconds=100).collect()
    }
    for key, ts, n in rows:
        earlier = [(t, i) for k, t, i in marks if k == key and t <= ts]
        latest = max(earlier, key=lambda m: m[0]) if earlier else (None, None)
        assert found[n][0] == latest[0]
        if sum(t == latest[0] for t, _ in earlier) == 1:
            assert found[n][1] == latest[1]

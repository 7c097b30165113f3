import random

import numpy as np
import pytest

from tidegauge.operators.distribution import bracketed, distribution


def summary(spark, rows, keys=("key",), percentiles=None):
    frame = spark.createDataFrame(rows, "key string, value double")
    out = distribution(
        frame, list(keys), "value", percentiles or {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    )
    return {tuple(r[k] for k in keys): r for r in out.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_equals_sorting(spark, seed):
    rng = random.Random(seed)
    draw = {
        "one": lambda: 7.25,
        "wide": lambda: rng.lognormvariate(0, 6),
        "signed": lambda: rng.gauss(0, 10),
        "narrow": lambda: 100 + rng.random() / 1000,
        "zeros": lambda: float(rng.random() > 0.97),
    }
    rows = [(key, f()) for key, f in draw.items() for _ in range(rng.randrange(1, 800))]
    found = summary(spark, rows)
    for key in draw:
        values = np.array([v for k, v in rows if k == key])
        row = found[(key,)]
        assert row["samples"] == len(values)
        assert row["avg"] == pytest.approx(values.mean(), rel=1e-12)
        assert (row["min"], row["max"]) == (values.min(), values.max())
        for name, p in (("p50", 50), ("p95", 95), ("p99", 99)):
            assert row[name] == pytest.approx(np.percentile(values, p), rel=1e-12)


def test_nulls_count_as_samples_only(spark):
    found = summary(spark, [("a", 1.0), ("a", None), ("a", 3.0), ("b", None), (None, 4.0)])
    assert (found[("a",)]["samples"], found[("a",)]["avg"], found[("a",)]["p50"]) == (3, 2.0, 2.0)
    assert (found[("b",)]["samples"], found[("b",)]["avg"], found[("b",)]["p95"]) == (1, None, None)
    assert found[(None,)]["p99"] == 4.0


def test_one_group_over_everything(spark):
    found = summary(spark, [("a", float(i)) for i in range(101)], keys=())
    assert found[()]["p95"] == 95.0


def test_no_rows(spark):
    assert summary(spark, []) == {}


@pytest.mark.parametrize("shape", ["narrow", "normal", "integers", "two", "sorted"])
def test_large_groups_order_only_what_is_near_the_ranks(spark, shape):
    rng = np.random.default_rng(4)
    values = {
        "narrow": 1_000_000 + np.arange(200_000) / 1e6, "normal": rng.normal(0, 1e6, 200_000),
        "integers": rng.integers(0, 50, 200_000).astype(float), "two": np.repeat([5.0, 7.0], 100_000),
        "sorted": np.arange(200_000, dtype=float),
    }[shape]
    frame = spark.createDataFrame([("a", float(v)) for v in values], "key string, value double").repartition(7)
    shares = {"p1": 0.01, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    out = distribution(frame, ["key"], "value", shares).first()
    for name, share in shares.items():
        assert out[name] == pytest.approx(np.percentile(values, 100 * share), rel=1e-12)
    ordered = bracketed(frame, ["key"], "value", shares)
    assert ordered.count() <= 4 * 200_000 * 12 / 10_000 + 6
    assert ordered.selectExpr("sum(_n)").first()[0] == 200_000


def test_values_that_are_no_number_are_the_greatest(spark):
    nan = float("nan")
    found = summary(spark, [("a", float(i)) for i in range(30_000)] + [("a", nan)] * 900 + [("a", None)] * 5)[("a",)]
    assert found["samples"] == 30_905 and found["p50"] == 15449.5
    assert np.isnan(found["max"]) and np.isnan(found["p99"])
    assert found["p95"] == pytest.approx(0.95 * 30_899)


def test_infinite_values(spark):
    inf = float("inf")
    found = summary(spark, [("a", v) for v in (-inf, 1.0, 2.0, 3.0, inf)])
    assert found[("a",)]["p50"] == 2.0 and found[("a",)]["max"] == inf

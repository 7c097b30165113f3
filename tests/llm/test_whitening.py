"""Whitening, held against numpy's own eigenvalues and exact whole numbers."""

import math
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from helpers import clashing  # noqa: E402
from tidegauge.llm import whitening as w  # noqa: E402
from tidegauge.llm.queries import QUERIES  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>"


def symmetric(draw, n, values=None):
    q, _ = np.linalg.qr(draw.standard_normal((n, n)))
    values = draw.standard_normal(n) if values is None else np.asarray(values, float)
    m = (q * values) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
def test_inertia_counts(n):
    draw = np.random.default_rng(n)
    for _ in range(20):
        m = symmetric(draw, n)
        values = np.linalg.eigvalsh(m)
        for shift in draw.standard_normal(8):
            assert w.above(m, shift) == int((values > shift).sum())
    hollow = 1 - np.eye(max(n, 2))  # zero diagonal: needs double pivots
    assert w.above(hollow, 0.0) == 1


@pytest.mark.parametrize("values", [
    [9, 4, 2, 1, 0.5], [5, 5, 5, 1, 1], [1, 1 - 1e-9, 1 - 2e-9, 0.5, 0.1], [3, 0, 0, 0, 0],
    [1e-9, 1e-10, 1e-11, 0, 0], [2, 2, 2, 2, 2], [1e12, 1, 1e-3, 0, 0],
])
def test_leading_components(values):
    m = symmetric(np.random.default_rng(3), 5, values)
    got, vectors = w.leading(m, 4)
    want = [v for v in values if v > w.LEAST_SHARE * sum(values)][:4]
    assert np.allclose(got, want, rtol=1e-9, atol=1e-13 * sum(values))
    assert np.allclose(vectors @ vectors.T, np.eye(len(got)), atol=1e-12)
    assert np.abs(m @ vectors.T - vectors.T * got).max() <= 1e-13 * sum(values)


def brute(rows):
    """{(vec_id, place, component): row} with signs left open, by exact sums and numpy's solver."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted(set(map(lambda r: tuple(r[1]), kept)))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array(distinct, float) - np.array([s / n for s in sums])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    told = []
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        projected = (np.array(x) - np.array(sums) / n) @ vectors / np.sqrt(values)
        told.append((i, n, deviation, projected, values / np.trace(cov)))
    return told


def test_query_against_numpy(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = {(r.vec_id, r.component): r for r in QUERIES["op11_spectrum_whitening"](spark, folder).collect()}
    want = brute(rows)
    assert len(got) == 4 * len(want)
    signs = {}
    for i, n, deviation, projected, explained in want:
        for c in range(4):
            r = got[i, c + 1]
            assert (r.n, r.deviation) == (n, deviation) and r.identity_error < 1e-9
            assert abs(r.explained - explained[c]) < 1e-9
            signs.setdefault(c, np.sign(r.whitened * projected[c]))
            assert abs(r.whitened - signs[c] * projected[c]) < 1e-9
    assert set(map(abs, signs.values())) == {1.0}


def test_odd_rows(spark):
    rows = [
        (1, [0.5, 0.25]), (1, [0.5, 0.25]), (2, None), (3, [0.5, None]), (4, [float("nan"), 1.0]),
        (5, [float("inf"), 1.0]), (None, [-0.5, 1.0]), (6, [0.0]), (7, []), (8, [1e-9, -0.0]), (9, [3.0, -2.0]),
    ]
    frame = clashing(spark.createDataFrame(rows, SCHEMA), "x", "v", "place", "whitened", "deviation")
    found, model = w.whiten(frame)
    kept = [(i, (list(v) + [0.0, 0.0])[:2]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    want = brute(kept)
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(((r.vec_id, r.deviation, r.whitened) for r in found.collect()), key=key)
    assert [(i, d) for i, d, _ in got] == sorted(((i, d) for i, _, d, _, _ in want), key=key)
    assert all(len(x) == 2 for _, _, x in got) and model.n == 4
    expected = sorted(((i, d, p[:2]) for i, _, d, p, _ in want), key=key)
    assert np.allclose(np.abs([x for *_, x in got]), np.abs([p for *_, p in expected]), atol=1e-9)


def test_equal_vectors_and_no_rows(spark):
    same = spark.createDataFrame([(i, [0.5, 1.0]) for i in range(5)], SCHEMA)
    found, model = w.whiten(same)
    assert [(r.deviation, r.whitened) for r in found.collect()] == [(0, [])] * 5
    assert model.n == 1 and model.identity_error is None
    found, model = w.whiten(spark.createDataFrame([], SCHEMA))
    assert found.collect() == [] and model.n == 0


def test_numbers_beyond_64_bits_have_no_deviation(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [1.0, 1.0])]
    found, model = w.whiten(spark.createDataFrame(rows, SCHEMA))
    told = {r.vec_id: r for r in found.collect()}
    assert told[1].deviation is None and len(told[3].whitened) == len(model.values) >= 1
    x = np.array([[1 << 40, -5]])
    assert w._deviations(x, 3, [7, 8]) == [None]
    assert w._deviations(x >> 12, 3, [7, 8]) == [(3 * (1 << 28) - 7) ** 2 + (3 * -1 - 8) ** 2]

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import clashing
from tidegauge.llm import exact_topk, hash_forest, queries

VECTORS = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")
ODD = [
    (0, [1.0, 2.0, 3.0], 1), (100, [1.0, 2.0, 3.0], None), (1, None, 1), (2, [1.0, None, 2.0], 1),
    (3, [NAN, 1.0, 1.0], 1), (4, [1.0, INF, 1.0], 1), (None, [1.0, 1.0, 1.0], 1), (5, [0.0, 0.0, 0.0], 1),
    (6, [], 1), (7, [1.0, 2.0, 3.0], 1), (7, [1.0, 2.0, 3.0], 1), (8, [2.0, -1.0], 1), (9, [-5.0, 0.5, 9.5, 4.0], 1),
    (200, [0.25, 0.5, -0.75], 1), (200, [0.25, 0.5, -0.75], 1),
] + [(10 + i, [float(i % 5), float(i % 3), -1.0], i) for i in range(30)]


def taking_part(rows, zero):
    out = []
    for vec_id, vector, *_ in rows:
        if vec_id is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        if zero or any(vector):
            out.append((vec_id, np.pad(np.array(vector, float), (0, 8 - len(vector))) if len(vector) < 8 else np.array(vector, float)))
    return out


def brute(rows, zero, score, reverse, k=10):
    rows = taking_part(rows, zero)
    out, seen = [], set()
    for query_id, q in sorted(rows, key=lambda r: (r[0], r[1].tolist())):
        if query_id % 100 or query_id in seen:
            continue
        seen.add(query_id)
        found = sorted(((score(q, v), i) for i, v in rows if i != query_id),
                       key=lambda x: (-x[0] if reverse else x[0], x[1]))
        out += [(query_id, rank, i, s) for rank, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


def product(q, v):
    return int(sum(int(np.floor(1024 * a)) * int(np.floor(1024 * b)) for a, b in zip(q, v)))


def distance(q, v):
    return float(np.sqrt(((q - v) ** 2).sum()))


def rows_of(frame):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in frame.collect())


def test_exact_odd_rows(spark):
    frame = clashing(spark.createDataFrame(ODD, VECTORS), "vector", "row_block", "score", "rank", "query_id")
    found = rows_of(exact_topk.top_products(frame, F.col("vec_id") % 100 == 0))
    assert found == brute(ODD, True, product, True)


def test_exact_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "ROWS_PER_BLOCK", 7)
    monkeypatch.setattr(exact_topk, "QUERIES_PER_BLOCK", 2)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=40).astype(np.float32)], 0) for i in range(0, 900, 9)]
    rows = [(i, v + [0.0] * 0, z) for i, v, z in rows]
    frame = spark.createDataFrame(rows, VECTORS)
    q = {i: np.array(v) for i, v, _ in rows}
    want = []
    for query_id in sorted(q):
        if query_id % 100 == 0:
            best = sorted((-product(q[query_id], v), i) for i, v in q.items() if i != query_id)[:10]
            want += [(query_id, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    assert rows_of(exact_topk.top_products(frame, F.col("vec_id") % 100 == 0)) == sorted(want)


def test_exact_of_huge_numbers():
    rows = np.array([[1e15, 1.0], [1e15, 2.0], [-1e18, 0.0]])
    q, r, s = exact_topk.search(np.array([1, 2, 3]), rows, np.array([0]), np.array([[3.0, 1.0]]), 2)
    assert r.tolist() == [1, 0]  # ordered exactly, told as the largest number of 64 bits
    assert s == [(1 << 63) - 1] * 2
    q, r, s = exact_topk.search(np.array([1, 2, 3]), rows / 1e3, np.array([0]), np.array([[3.0, 1.0]]), 2)
    assert r.tolist() == [1, 0] and s[1] == int(1024e12) * 3072 + 1 * 1024


def test_bounds_never_rule_out_a_better_row():
    rng = np.random.default_rng(1)
    rows, queries_ = rng.normal(size=(400, 64)), rng.normal(size=(20, 64))
    true = ((rows[None] - queries_[:, None]) ** 2).sum(axis=2)
    for segments in exact_topk.RESOLUTIONS:
        a, b = (exact_topk.segment_features(m, segments) for m in (rows, queries_))
        bound = ((a[None] - b[:, None]) ** 2).sum(axis=2)
        assert (bound <= true + 1e-9).all()


def test_forest_odd_rows(spark):
    frame = clashing(spark.createDataFrame(ODD, VECTORS), "vector", "row_block", "score", "rank")
    found = rows_of(hash_forest.nearest(frame, F.col("vec_id") % 100 == 0))
    want = brute(ODD, False, distance, False)
    # The block is small: the ascent may end before the root, but every row found is right.
    assert {(q, r) for q, r, *_ in found} == {(q, r) for q, r, *_ in want}
    vectors = dict(taking_part(ODD, False))
    for query_id, _, vec_id, score in found:
        assert score == pytest.approx(distance(vectors[query_id], vectors[vec_id]), abs=0)


def test_forest_finds_all_of_few(spark):
    rows = [(i, [float(i), 1.0], 0) for i in range(8)]
    found = rows_of(hash_forest.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0))
    assert found == brute(rows, False, distance, False)


def test_forest_copies_are_found_in_order_of_id(spark):
    rows = [(i, [1.0, 2.0, 0.5] if i % 3 == 0 else [float(i), -1.0, 2.0], 0) for i in range(300)]
    found = rows_of(hash_forest.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 0))
    assert [(i, s) for _, _, i, s in found] == [(3 * j, 0.0) for j in range(1, 11)]


def test_rows_of_many_copies_travel_as_one(spark):
    rows = [(7, [1.0, 2.0, 3.0], 0)] * 5000 + [(i, [float(i % 11), 1.0, float(i % 7)], 0) for i in range(0, 300, 3)]
    frame = spark.createDataFrame(rows, VECTORS)
    found = rows_of(exact_topk.top_products(frame, F.col("vec_id") % 100 == 0))
    assert found == brute(rows[:10] + rows[5000:], True, product, True)
    found = rows_of(hash_forest.nearest(frame, F.col("vec_id") % 100 == 0))
    assert found == brute(rows[:10] + rows[5000:], False, distance, False)


def test_queries_stream_past_blocks_of_unequal_widths(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "ROWS_PER_BLOCK", 9)
    monkeypatch.setattr(exact_topk, "QUERIES_PER_BLOCK", 13)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        rng = np.random.default_rng(5)
        rows = [(i, [float(x) for x in rng.normal(size=1 + i % 6).astype(np.float32)], 0) for i in range(60)]
        frame = spark.createDataFrame(rows, VECTORS)
        found = rows_of(exact_topk.top_products(frame, F.col("vec_id") >= 0))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    vectors = dict(taking_part(rows, True))
    want = []
    for query_id, q in vectors.items():
        best = sorted((-product(q, v), i) for i, v in vectors.items() if i != query_id)[:10]
        want += [(query_id, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    assert found == sorted(want)


def test_the_forest_measures_under_half_of_a_block():
    rng = np.random.default_rng(6)
    rows, ids = rng.normal(size=(2000, 32)), np.arange(2000)
    block = hash_forest.Block(ids, rows, 10, hash_forest.TREES, hash_forest.BITS, hash_forest.SHARE, 9)
    first, last = block.forest.ranges(rows[:40])
    measured = [block.measured(first[:, i], last[:, i], i) for i in range(40)]
    assert np.mean([len(m) for m in measured]) < 1000
    hits = 0
    for i, found in enumerate(measured):
        d = ((rows - rows[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        hits += len(set(np.argsort(d)[:10]) & set(found))
    assert hits >= 360


def test_no_vectors(spark):
    frame = spark.createDataFrame([], VECTORS)
    assert exact_topk.top_products(frame, F.col("vec_id") % 100 == 0).collect() == []
    assert hash_forest.nearest(frame, F.col("vec_id") % 100 == 0).collect() == []


def test_recall(spark):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in table])
    vectors = np.array([r.embedding for r in table], float)
    found = rows_of(queries.QUERIES["op9_hash_forest"](spark, folder))
    hits = total = 0
    for query_id in ids[ids % 100 == 0]:
        d = np.sqrt(((vectors - vectors[ids == query_id][0]) ** 2).sum(axis=1))
        d[ids == query_id] = np.inf
        best = set(ids[np.lexsort((ids, d))[:10]].tolist())
        hits += len(best & {v for q, _, v, _ in found if q == query_id})
        total += 10
    assert hits / total >= 0.95

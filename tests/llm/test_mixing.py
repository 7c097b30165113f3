from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import clashing, no_docs, odd_docs
from tidegauge.llm import mixing, queries
from tidegauge.llm.common import word_count


def mixed(docs, members=None):
    members = F.array("source") if members is None else members
    return mixing.mix(docs, [F.col("doc_id"), F.col("text")], members, word_count(F.col("text")))


def targets_by_steps(sizes, weights, total):
    """Brute force: raise the water level in small steps."""
    low, high = 0.0, float(total) * 10
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(3 * s, level * w) for s, w in zip(sizes, weights)) < total:
            low = level
        else:
            high = level
    return [min(3 * s, low * w) for s, w in zip(sizes, weights)]


def test_targets():
    for sizes in ([10, 10, 10], [1, 50, 100, 3], [0, 5], [7], [100, 1, 1, 1, 1, 1, 1]):
        weights = [(1, 2, 3)[i % 3] for i in range(len(sizes))]
        found = mixing.water_filled(sizes, weights, sum(sizes), 3)
        assert found == pytest.approx(targets_by_steps(sizes, weights, sum(sizes)), abs=1e-6)


def test_query(spark):
    rows = queries.QUERIES["op8_source_mix"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000
    taken, target = defaultdict(int), {}
    sources = {r.doc_id: r.source for r in spark.read.parquet(
        "/root/testdata/sf0.01/documents.parquet").select("doc_id", "source").collect()}
    sizes = defaultdict(int)
    for r in rows:
        source = sources[r.doc_id]
        taken[source] += r.taken
        sizes[source] += r.size
        target[source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    names = sorted(sizes)
    wanted = mixing.water_filled([sizes[s] for s in names], [(1, 2, 3)[i % 3] for i in range(len(names))],
                                 sum(sizes.values()), 3)
    for name, goal in zip(names, wanted):
        assert target[name] == pytest.approx(goal)
        assert abs(taken[name] - goal) <= 1
    assert all(r.source_size == sizes[sources[r.doc_id]] for r in rows)
    again = queries.QUERIES["op8_source_mix"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(rows) == sorted(again)


def test_odd_rows(spark):
    docs = clashing(odd_docs(spark), "size", "pattern", "bucket", "place", "taken")
    rows = mixed(docs).select("doc.doc_id", "doc.source", "size", "taken", "shares").collect()
    assert len(rows) == docs.count()
    by_source = defaultdict(lambda: [0, 0, 0.0])
    for r in rows:
        found = by_source[r.source]
        found[0] += r["size"]
        found[1] += r["taken"]
        found[2] = r.shares[0].target
    names = sorted(by_source, key=lambda x: (x is None, x or ""))
    assert names == ["", "a", "b", "c", "ü", None]
    for i, name in enumerate(names):
        size, taken, target = by_source[name]
        assert abs(taken - target) <= 1 and target <= 3 * size
    assert mixed(no_docs(spark)).collect() == []


def test_repeats_and_cut(spark):
    docs = odd_docs(spark)
    whole = mixed(docs)
    out = mixing.repeated(whole)
    assert out.columns == docs.columns
    words = out.select(F.sum(word_count(F.col("text")))).first()[0]
    assert words == whole.select(F.sum("taken")).first()[0]


def brute_flow(patterns, quotas, most):
    """Least cost over all ways to route small whole flows."""
    names = list(patterns)
    best = [None]

    def cost(p, used):
        return sum(k // patterns[p] for k in range(used))

    def walk(i, left, routed, spent):
        if i == len(names):
            key = (-routed, spent)
            if best[0] is None or key < best[0]:
                best[0] = key
            return
        p = names[i]

        def split(j, rest, used):
            if j == len(p):
                walk(i + 1, dict(rest), routed + used, spent + cost(p, used))
                return
            for amount in range(min(rest[p[j]], most * patterns[p] - used) + 1):
                rest[p[j]] -= amount
                split(j + 1, rest, used + amount)
                rest[p[j]] += amount

        split(0, dict(left), 0)

    walk(0, dict(quotas), 0, 0)
    return best[0]


def test_flow_is_of_least_cost():
    cases = [
        ({("a",): 2, ("a", "b"): 3, ("b",): 1}, {"a": 5, "b": 4}),
        ({("a", "b"): 2, ("b", "c"): 2, ("c",): 1}, {"a": 3, "b": 3, "c": 4}),
        ({("a",): 1, ("b",): 3, ("a", "b"): 2}, {"a": 4, "b": 3}),
    ]
    for patterns, quotas in cases:
        flow = mixing.route(patterns, quotas, 3)
        routed = sum(sum(f.values()) for f in flow.values())
        spent = sum(sum(k // patterns[p] for k in range(sum(flow[p].values()))) for p in patterns)
        for p in patterns:
            assert sum(flow[p].values()) <= 3 * patterns[p] and min([0, *flow[p].values()]) >= 0
        for source, quota in quotas.items():
            assert sum(f.get(source, 0) for f in flow.values()) <= quota
        assert (-routed, spent) == brute_flow(patterns, quotas, 3)


def test_overlapping_sources(spark):
    docs = spark.createDataFrame(
        [(i, "x " * (1 + i % 7), ["a"] if i % 3 == 0 else ["a", "b"] if i % 3 == 1 else []) for i in range(300)],
        "doc_id long, text string, members array<string>",
    )
    rows = mixed(docs, F.col("members")).collect()
    by_source, goal = defaultdict(int), {}
    for r in rows:
        assert r.taken <= 3 * r["size"] and r.taken == sum(s.taken for s in r.shares)
        if not r.doc.members:
            assert r.taken == 0
        for s in r.shares:
            by_source[s.source] += s.taken
            goal[s.source] = s.target
    for source, target in goal.items():
        assert abs(by_source[source] - target) <= 1

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import clashing, no_docs, odd_docs, odd_rows, sentence
from tidegauge.llm import components as stars
from tidegauge.llm import queries, shingle_join, shingles


def words(text):
    return (text or "").encode().lower().split()


def brute_set(text):
    w = words(text)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows, threshold=75):
    """(n_shingles, component_id) of each row, over all pairs."""
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].add(i)
    for i, s in enumerate(sets):
        for j in set().union(*(holders[x] for x in s)) if s else ():
            if j > i and 100 * len(s & sets[j]) >= threshold * len(s | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    names = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        names[find(i)].append(doc_id)
    smallest = {k: min((x for x in v if x is not None), default=None) for k, v in names.items()}
    return sorted(
        ((doc_id, len(s), smallest[find(i)] if s else doc_id) for i, ((doc_id, _), s) in enumerate(zip(rows, sets))),
        key=repr,
    )


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r)[:3] for r in shingle_join.join(frame, **options).collect()), key=repr)


def edited(rng, base, share):
    return " ".join(rng.choice(["new", "odd", f"v{rng.randrange(10**6)}"]) if rng.random() < share else w for w in base)


def corpus(seed, groups=25, hot=120):
    """Chains of near copies at similarities around the threshold, and passages that many share."""
    rng = random.Random(seed)
    rows, passage = [], [f"p{i}" for i in range(60)]
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(rng.choice([3, 5, 6, 20, 60, 200]))]
        for _ in range(rng.randrange(1, 7)):
            rows.append(edited(rng, base, rng.choice([0, 0, 0.01, 0.03, 0.05])))
            if rng.random() < 0.3:
                base = rows[-1].split()
        rows.append(" ".join([*base[:rng.randrange(1, 40)], *passage]))
    near = [f"hot{i}" for i in range(100)]
    rows += [edited(rng, near, rng.choice([0.01, 0.02, 0.04])) for _ in range(hot)]
    rows += [" ".join(near[:rng.randrange(60, 100)]) + f" t{i}" for i in range(hot // 4)]
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == brute(rows)


def test_open_lists_take_further_heads(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "OPEN_PAIRS", 0)
    rows = corpus(3, groups=10, hot=80)
    assert found(spark, rows) == brute(rows)


def test_small_buckets_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "SHINGLES_AT_ONCE", 300)
    monkeypatch.setattr(shingle_join, "BYTES_PER_BUCKET", 4000)
    rows = corpus(4, groups=12, hot=40)
    assert found(spark, rows) == brute(rows)


def test_similarity_at_the_border(spark):
    base = [f"b{i}" for i in range(20)]  # 16 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:16])), (3, " ".join(base[:15])), (4, " ".join(base[5:]))]
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    docs = clashing(odd_docs(spark), "n", "digest", "mark", "shingles", "bucket", "component_id")
    rows = sorted((tuple(r)[:3] for r in shingle_join.join(docs).collect()), key=repr)
    assert rows == brute([(r[0], r[1]) for r in odd_rows()])
    assert shingle_join.join(no_docs(spark)).collect() == []
    assert shingle_join.representatives(no_docs(spark)).collect() == []


def test_representatives(spark):
    docs = clashing(odd_docs(spark), "kept_mark", "doc")
    kept = shingle_join.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 3, 4, 7, 10, 11, 12]
    assert kept.where("doc_id IS NULL").count() == 1


def test_representatives_of_null_and_repeated_ids(spark):
    a, b, c, d = (sentence(seed, 80) for seed in (21, 22, 23, 24))
    rows = [
        (None, a), (None, a), (None, a + " tail"), (None, b), (5, c), (5, d), (5, d), (6, c + " tail"),
        (None, d + " tail"), (None, ""), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((tuple(r) for r in shingle_join.representatives(docs).collect()), key=repr)
    near = [r for r in kept if r in [(None, a), (None, a + " tail")]]
    assert len(near) == 1
    assert sorted((r for r in kept if r not in near), key=repr) == sorted(
        [(None, b), (5, c), (5, d), (None, ""), (None, None)], key=repr)
    assert shingle_join.join(docs).columns == ["doc_id", "n_shingles", "component_id", "mark"]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in queries.QUERIES["op10_shingle_join"](spark, sf).collect()), key=repr) == brute(rows)


@given(st.lists(st.text(alphabet="aAbß é\t\n\x0b\x0c\r\x1c ", max_size=40), max_size=12), st.sampled_from([2, 5, 8, 64, 1 << 20]))
@settings(max_examples=300, deadline=None)
def test_sets(texts, buffer):
    before, shingles.BUFFER = shingles.BUFFER, buffer
    try:
        made = list(shingles.shingle_sets(texts))
    finally:
        shingles.BUFFER = before
    assert [len(s) for s in made] == [len(brute_set(t)) for t in texts]
    for a, x in zip(texts, made):
        assert (np.diff(x.astype(object)) > 0).all()
        for b, y in zip(texts, made):
            assert len(np.intersect1d(x, y)) == len(brute_set(a) & brute_set(b))


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(300)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in stars.components(frame, "test").collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            root[max(find(a), find(b))] = min(find(a), find(b))
    assert got.keys() == root.keys()
    assert {(a, b) for a in root for b in root if got[a] == got[b]} == {
        (a, b) for a in root for b in root if find(a) == find(b)}
    assert stars.components(frame.where("a < 0"), "none").collect() == []


def test_links_are_added_to_components(spark):
    first = spark.createDataFrame([(1, 2), (3, 4), (8, 9)], "a long, b long")
    labels = stars.components(first, "first")
    more = spark.createDataFrame([(2, 4), (5, 6), (6, 1), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in stars.joined_labels(labels, more, "more").collect()}
    assert {got[x] for x in (1, 2, 3, 4, 5, 6)} == {got[1]} and got[8] == got[9] != got[1] and len(got) == 8
    assert stars.joined_labels(labels, more.where("a > 9"), "none") is labels


def test_words_longer_than_buffers(monkeypatch):
    monkeypatch.setattr(shingles, "BUFFER", 1000)
    giant, texts = "X" * 50_000, []
    for lead in ("", "a ", "a b c d ", "q " * 600):
        texts += [f"{lead}{giant}", f"{lead}{giant.lower()} tail b c d e f", f"{lead} {'y' * 2000} {'y' * 2001} z w"]
    made = list(shingles.shingle_sets(texts))
    assert [len(s) for s in made] == [len(brute_set(t)) for t in texts]
    for a, x in zip(texts, made):
        for b, y in zip(texts, made):
            assert len(np.intersect1d(x, y)) == len(brute_set(a) & brute_set(b))

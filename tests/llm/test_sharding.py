from collections import Counter, defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from helpers import clashing, no_docs, odd_docs
from tidegauge.llm import hilbert_shards, queries


@pytest.mark.parametrize("dimensions,bits", [(2, 3), (3, 2), (4, 3)])
def test_curve_visits_neighbours_one_by_one(dimensions, bits):
    cells = sorted(product(range(1 << bits), repeat=dimensions),
                   key=lambda c: hilbert_shards.hilbert_index(c, bits))
    assert sorted(hilbert_shards.hilbert_index(c, bits) for c in cells) == list(range(len(cells)))
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(cells, cells[1:]))


def assert_law(rows, shards=40):
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) <= set(range(shards))
    if len(rows) >= shards:
        assert len(counts) == shards
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query(spark):
    import zlib

    rows = queries.QUERIES["op6_hilbert_shards"](spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(texts) and {r.doc_id for r in rows} == set(texts)
    assert_law(rows)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)
    assert [r.curve_index for r in sorted(rows, key=lambda r: (r.shard, r.slot))] == sorted(r.curve_index for r in rows)


def test_odd_rows(spark):
    docs = clashing(odd_docs(spark), "cell", "place", "rank", "slot", "curve_index", "inside")
    key = [F.col("doc_id"), F.col("text")]
    dimensions = [F.col("source"), F.col("n_chars"), F.col("doc_id")]
    rows = hilbert_shards.shard(docs, dimensions, key, shards=4).collect()
    assert len(rows) == docs.count()
    assert_law(rows, 4)
    assert_law(hilbert_shards.shard(docs, dimensions, key).collect())
    assert hilbert_shards.shard(no_docs(spark), [F.col("n_chars")], [F.col("doc_id")]).collect() == []


def test_one_hot_cell_is_ranked_in_parts(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("size"))
    placed = hilbert_shards.shard(docs, [F.col("size")], [F.col("doc_id")])
    assert_law(placed.collect())
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(curve_index" in plan and "part" in plan


def test_files_hold_runs_of_the_curve(spark, tmp_path):
    docs = odd_docs(spark)
    placed = hilbert_shards.shard(docs, [F.col("n_chars")], [F.col("doc_id")], shards=3)
    hilbert_shards.write_shards(placed, str(tmp_path / "out"), rows_per_file=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.select("curve_shard").distinct().count() == 3


def test_texts_with_a_common_beginning_get_levels_of_their_own(spark):
    names = ["github-java", "github-python", "github-rust"]
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.element_at(F.array(*map(F.lit, names)), (F.col("id") % 3 + 1).cast("int")).alias("source"))
    assert hilbert_shards.text_cuts(docs, F.col("source"), 8) == names[1:]
    rows = hilbert_shards.shard(docs, [F.col("source"), F.col("doc_id")], [F.col("doc_id")], shards=30).collect()
    assert_law(rows, 30)
    by_source = defaultdict(set)
    for r in rows:
        by_source[r.doc.source].add(r.shard)
    assert all(len(found) <= 14 for found in by_source.values())


def test_text_cuts_against_ranks(spark):
    import random

    draw = random.Random(2)
    values = ["https://example.org/" + draw.choice("abcdefghij") * draw.randrange(1, 4) for _ in range(700)]
    values += ["", "é", "漢", None, None] + ["hot"] * 300
    docs = spark.createDataFrame([(v,) for v in values], "v string").repartition(7)
    told = sorted((v for v in values if v is not None), key=lambda v: v.encode())
    least = {}
    for i, v in enumerate(told):
        least.setdefault(told.index(v) * 8 // len(told), v)
    assert hilbert_shards.text_cuts(docs, F.col("v"), 8) == [least[k] for k in sorted(least)][1:]
    assert hilbert_shards.text_cuts(docs.where("v IS NULL"), F.col("v"), 8) == []


def test_equal_rows_are_spread_over_parts(spark):
    docs = spark.range(0, 5000, 1, 4).selectExpr("CAST(NULL AS bigint) AS doc_id", "1 AS size")
    placed = hilbert_shards.shard(docs, [F.col("size")], [F.col("doc_id")])
    assert_law(placed.collect())
    plan = placed._jdf.queryExecution().analyzed().toString()
    assert "monotonically_increasing_id" in plan or "parquet" in plan

"""A set of query vectors against all vectors, in blocks of bounded size.

Rows and queries are dealt to blocks by a hash. The rows of a block are indexed once; then a block of
queries streams by, a batch at a time. What a task holds is one block of rows and one batch of
queries, whatever the table's size. Equal rows travel as one, with their number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.llm.common import seeded

#: Queries that pass one index. Beyond them a block of rows is sent and indexed again, which bounds
#: the work that is lost with an executor.
QUERIES_PER_BLOCK = 65536


def usable(vectors: DataFrame, vec_id: str, vector: str, zero: bool) -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the rows that take part.

    Rows take no part whose id or vector is null, or whose vector holds a null or a value that is
    not finite; nor, unless ``zero``, vectors of nothing but zeros.
    """
    bad = "x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity')"
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    ).where(f"vec_id IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, {bad})")
    return rows if zero else rows.where("exists(vector, x -> x <> 0)")


def best_of_blocks(
    rows: DataFrame,
    is_query: Column,
    k: int,
    index: Callable[[np.ndarray, np.ndarray], object],
    score: str,
    ascending: bool,
    rows_per_block: int,
    queries_per_block: int,
) -> DataFrame:
    """The ``k`` best rows of each query: query_id, rank, vec_id and ``score``.

    ``index`` makes an index of the ids and vectors of a block's rows. Its ``search`` gets the ids and
    vectors of queries and returns the places of queries, places of rows and scores of each query's
    best in that block. Rows with a query's own id are no candidates of it. Rows of one id that are
    queries count as one query, of the smallest vector; as candidates all rows count.
    """
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    row_blocks = max(1, -(-rows.count() // rows_per_block))
    query_blocks = max(1, -(-queries.count() // queries_per_block))
    home = lambda blocks: F.pmod(seeded(3, F.col("vec_id"), F.col("vector")), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = rows.groupBy("vec_id", "vector").agg(F.count("*").alias("copies")).select(
        home(row_blocks).alias("row_block"), every(query_blocks).alias("query_block"),
        F.lit(False).alias("asks"), "vec_id", "copies", "vector",
    )
    right = queries.select(
        every(row_blocks).alias("row_block"), home(query_blocks).alias("query_block"),
        F.lit(True).alias("asks"), "vec_id", F.lit(1).cast("long").alias("copies"), "vector",
    )
    kind = pa.int64() if score == "long" else pa.float64()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block, made = None, [], None
        for place, asks, piece in _pieces(batches):
            if place != at:
                at, block, made = place, [], None
            if not asks:
                block.append(piece)
                continue
            if not block:
                continue
            query_ids, asked = _matrix(pa.Table.from_batches([piece]))
            if made is None:
                held = pa.Table.from_batches(block)
                ids, vectors = _matrix(held)
                copies = held["copies"].to_numpy()
            if made is None or asked.shape[1] > vectors.shape[1]:
                vectors = _wide(vectors, max(vectors.shape[1], asked.shape[1]))
                made = index(ids, vectors)
            q, r, s = made.search(query_ids, _wide(asked, vectors.shape[1]))
            yield pa.record_batch({
                "query_id": pa.array(query_ids[q], pa.int64()), "vec_id": pa.array(ids[r], pa.int64()),
                "score": pa.array(s, kind), "copies": pa.array(np.minimum(copies[r], k), pa.int32()),
            })

    found = (
        left.unionAll(right).repartition("row_block", "query_block")
        .sortWithinPartitions("row_block", "query_block", "asks", "vec_id")
        .mapInArrow(meet, f"query_id long, vec_id long, score {score}, copies int")
        .withColumn("copy", F.explode(F.expr("array_repeat(0, copies)")))
    )
    order = F.col("score").asc() if ascending else F.col("score").desc()
    best = Window.partitionBy("query_id").orderBy(order, "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], bool, pa.RecordBatch]]:
    """The runs of rows of one pair of blocks and one kind, with that pair and kind."""
    for batch in batches:
        keys = np.stack([
            batch.column(name).to_numpy(zero_copy_only=False).astype(int)
            for name in ("row_block", "query_block", "asks")
        ], axis=1)
        borders = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for start, end in zip([0, *borders], [*borders, len(keys)]):
            if end > start:
                yield tuple(keys[start, :2]), bool(keys[start, 2]), batch.slice(start, end - start)


def _matrix(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a block; shorter vectors are continued with zeros."""
    ids = block["vec_id"].to_numpy()
    lists = block["vector"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.float64()))
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.empty(0, int)
    width = int(lengths.max()) if len(lengths) else 0
    if len(lengths) and (lengths == width).all():
        return ids, flat.reshape(len(ids), width)
    whole = np.zeros((len(ids), width))
    whole[np.arange(width)[None, :] < lengths[:, None]] = flat
    return ids, whole


def _wide(vectors: np.ndarray, width: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))

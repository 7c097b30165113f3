"""Exact search for the largest inner products, by segment statistics from coarse to fine.

Cut into segments, vectors q and x are at least as far apart as their segments' means and
deviations: |q - x|^2 >= sum of L ((mean_q - mean_x)^2 + (dev_q - dev_x)^2). Since |q - x|^2 =
|q|^2 + |x|^2 - 2 q.x, a row whose bound is too far for the k-th best product known so far cannot be
among the best. Rows that no resolution rules out are computed exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from tidegauge.llm.blocks import QUERIES_PER_BLOCK, best_of_blocks, usable

#: Segments of the resolutions, coarse to fine.
RESOLUTIONS = (2, 8, 32)
ROWS_PER_BLOCK = 8192
#: Sums of products below this are whole in doubles.
_WHOLE = float(1 << 52)
_QUERIES_AT_ONCE = 64


def segment_features(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, scaled so that distances between features are the
    lower bounds of distances between vectors."""
    parts = np.array_split(vectors, min(segments, max(1, vectors.shape[1])), axis=1)
    columns = []
    for part in parts:
        if part.shape[1]:
            scale = np.sqrt(part.shape[1])
            columns += [part.mean(axis=1) * scale, part.std(axis=1) * scale]
    return np.stack(columns, axis=1) if columns else np.zeros((len(vectors), 1))


class Block:
    """A block's rows, their features at every resolution, and the search among them."""

    def __init__(self, ids, rows, k: int):
        self.ids, self.rows, self.k = ids, np.floor(1024 * rows), k
        self.squares = (self.rows ** 2).sum(axis=1)
        # Components of like variance share a segment, so that the first segments tell most.
        self.cut = np.argsort(-self.rows.var(axis=0), kind="stable")
        self.levels = [segment_features(self.rows[:, self.cut], s) for s in RESOLUTIONS]

    def search(self, query_ids, queries):
        """Best rows of each query: places of queries and rows, and scores."""
        ids, rows, k = self.ids, self.rows, self.k
        queries = np.floor(1024 * queries)
        top = lambda m: float(np.abs(m).max()) if m.size else 0.0
        whole = top(rows) * top(queries) * max(1, rows.shape[1]) < _WHOLE

        def exact(row_places, query):
            if whole:
                return rows[row_places] @ query
            numbers = [int(v) for v in query]
            return np.array(
                [sum(int(a) * b for a, b in zip(rows[i], numbers)) for i in row_places],
                dtype=object
            )

        query_squares = (queries ** 2).sum(axis=1)
        levels = [
            (features, segment_features(queries[:, self.cut], s))
            for features, s in zip(self.levels, RESOLUTIONS)
        ]
        out_q, out_r, out_s = [], [], []
        for start in range(0, len(queries), _QUERIES_AT_ONCE):
            some = slice(start, start + _QUERIES_AT_ONCE)
            alive = ids[None, :] != query_ids[some, None]
            places = np.arange(len(ids))  # of the rows that are alive for any of these queries
            reached = np.full(len(alive), -np.inf)
            for row_features, query_features in levels:
                # Least squared distances, less what rounding may have added, and the largest
                # products they leave possible.
                both = self.squares[places][None, :] + query_squares[some, None]
                least = both - 2 * (query_features[some] @ row_features[places].T)
                least -= 1e-9 * both + 1e-6
                most = np.where(alive, (both - least) / 2, -np.inf)
                for i in range(len(alive)):
                    if len(places) > k:
                        likely = np.argpartition(-most[i], k - 1)[:k]
                        likely = likely[alive[i][likely]]
                        if len(likely) == k:
                            found = float(np.min(exact(places[likely], queries[start + i])))
                            reached[i] = max(reached[i], found)
                alive = alive & (most >= reached[:, None])
                kept = alive.any(axis=0)
                places, alive = places[kept], alive[:, kept]
            for i in range(len(alive)):
                left = places[alive[i]]
                scores = exact(left, queries[start + i])
                if whole and len(left) > k:  # all that reach the k-th score
                    keep = scores >= -np.partition(-scores, k - 1)[k - 1]
                    left, scores = left[keep], scores[keep]
                if whole:
                    order = np.lexsort((ids[left], -scores))[:k]
                else:
                    order = sorted(range(len(left)), key=lambda j: (-scores[j], ids[left[j]]))[:k]
                out_q += [start + i] * len(order)
                out_r += left[order].tolist()
                out_s += [max(-(1 << 63), min((1 << 63) - 1, int(scores[j]))) for j in order]
        return np.array(out_q, int), np.array(out_r, int), out_s


def search(ids, rows, query_ids, queries, k: int):
    """Best rows of each query in one block."""
    return Block(ids, rows, k).search(query_ids, queries)


def top_products(
    vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Each query's ``k`` rows of largest inner product of floor(1024 * x): query_id, rank, vec_id,
    score; ties to the smaller vec_id. ``is_query`` is a condition on vec_id.

    Vectors that are null or hold null or non-finite components take no part, nor do rows without
    an id, which could not be named. Vectors of unequal length are continued with zeros; an empty
    one has product 0 with all. A query's own id is no candidate of it. Repeated rows are candidates
    each, and one query (of the smallest vector, if they differ). Scores beyond 64 bits are ordered
    exactly and told as the nearest such number. Other columns are not looked at. An empty table, or
    one without queries, gives no rows.
    """
    return best_of_blocks(
        usable(vectors, vec_id, vector, zero=True), is_query, k,
        lambda ids, rows: Block(ids, rows, k),
        "long", False, ROWS_PER_BLOCK, QUERIES_PER_BLOCK,
    )

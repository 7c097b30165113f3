"""Approximate nearest neighbours by a forest of sorted hash strings.

Each tree hashes a vector to a long string of bits, signs of its projections against their median,
and holds its strings in a sorted array. A query descends in every tree to its longest prefix match;
then all trees ascend together, a bit at a time, until the prefixes they share with the query hold
enough candidates. Those that most trees bring are measured exactly. Rows are indexed in blocks, each
with a forest of its own, so recall does not fall as tables grow.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from tidegauge.llm.blocks import QUERIES_PER_BLOCK, best_of_blocks, usable

ROWS_PER_BLOCK = 16384
TREES = 96
BITS = 32
#: Candidates at which the ascent ends, counted once for each tree that brings them, as a multiple of
#: the block's rows.
ASCENT = 4.0
#: Of these, those that most trees bring are measured: this share of the block's rows, and all that as
#: many trees bring as the last of them.
SHARE = 0.3
#: In blocks where that share is fewer, this many.
LEAST = 192
_QUERIES_AT_ONCE = 256


class Forest:
    """The trees over one block of rows."""

    def __init__(self, rows: np.ndarray, trees: int, bits: int, seed: int):
        draw = np.random.default_rng(seed)
        self.trees, self.bits, self.size = trees, bits, len(rows)
        self.planes = draw.standard_normal((trees, rows.shape[1], bits)).astype(np.float32)
        self.weights = (1 << np.arange(bits - 1, -1, -1, dtype=np.uint64))
        self.scale = float(np.abs(rows).max()) or 1.0
        self.medians, self.order, self.strings = [], [], []
        small = (rows / self.scale).astype(np.float32)
        for planes in self.planes:
            projected = small @ planes
            median = np.median(projected, axis=0)
            strings = self._strings(projected, median)
            order = np.argsort(strings, kind="stable")
            self.medians.append(median)
            self.order.append(order)
            self.strings.append(strings[order])

    def _strings(self, projected: np.ndarray, median: np.ndarray) -> np.ndarray:
        return (projected > median).astype(np.uint64) @ self.weights

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where, in each tree, the strings lie that share a prefix of each length with a query:
        first and last place, by (prefix length, query, tree)."""
        shape = (self.bits + 1, len(queries), self.trees)
        first, last = np.zeros(shape, np.int32), np.zeros(shape, np.int32)
        last[0] = self.size
        small = (queries / self.scale).astype(np.float32)
        for t in range(self.trees):
            own = self._strings(small @ self.planes[t], self.medians[t])
            for length in range(1, self.bits + 1):
                rest = np.uint64(self.bits - length)
                prefix = (own >> rest) << rest
                first[length, :, t] = np.searchsorted(self.strings[t], prefix, "left")
                last[length, :, t] = np.searchsorted(
                    self.strings[t], prefix + (np.uint64(1) << rest), "left"
                )
                if not (last[length, :, t] > first[length, :, t]).any():
                    break  # no query matches so far, nor further
        return first, last

    def candidates(self, first: np.ndarray, last: np.ndarray, enough: float, least: int) -> np.ndarray:
        """Rows of one query: of the longest prefix, equal in all trees, that brings enough of them,
        at least ``least``, those that most trees bring."""
        counts = (last - first).sum(axis=1)
        length = max(0, int((counts >= enough).sum()) - 1)
        while True:
            votes = np.bincount(
                np.concatenate([
                    self.order[t][first[length, t]:last[length, t]] for t in range(self.trees)
                ]), minlength=self.size,
            )
            if length == 0 or np.count_nonzero(votes) >= least:
                break
            length -= 1
        if least >= self.size:
            return np.arange(self.size)
        fewest = np.partition(votes, self.size - least)[self.size - least]
        return np.flatnonzero(votes >= fewest)


class Block:
    """A block's rows, their forest, and the search in it."""

    def __init__(self, ids, rows, k: int, trees: int, bits: int, share: float, seed: int):
        self.ids, self.rows, self.k = ids, rows, k
        self.forest = Forest(rows, trees, bits, seed)
        self.least = max(int(share * len(rows)), LEAST)
        # The query's own rows are found too; as many candidates are needed beside them.
        self.own = {i: int(n) for i, n in zip(*np.unique(ids, return_counts=True))}

    def measured(self, first: np.ndarray, last: np.ndarray, query_id: int) -> np.ndarray:
        """Places of the rows whose distance from a query is computed."""
        least = max(self.least, self.k + self.own.get(query_id, 0))
        found = self.forest.candidates(
            first, last, ASCENT * len(self.rows), min(least, len(self.rows))
        )
        return found[self.ids[found] != query_id]

    def search(self, query_ids, queries):
        """Nearest rows found of each query: places of queries and rows, and distances."""
        out_q, out_r, out_s = [], [], []
        for start in range(0, len(queries), _QUERIES_AT_ONCE):
            first, last = self.forest.ranges(queries[start:start + _QUERIES_AT_ONCE])
            for i in range(first.shape[1]):
                found = self.measured(first[:, i], last[:, i], query_ids[start + i])
                distances = np.sqrt(((self.rows[found] - queries[start + i]) ** 2).sum(axis=1))
                if len(found) > self.k:
                    keep = distances <= np.partition(distances, self.k - 1)[self.k - 1]
                    found, distances = found[keep], distances[keep]
                order = np.lexsort((self.ids[found], distances))[:self.k]
                out_q += [start + i] * len(order)
                out_r += found[order].tolist()
                out_s += distances[order].tolist()
        return np.array(out_q, int), np.array(out_r, int), out_s


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    trees: int = TREES,
    bits: int = BITS,
    share: float = SHARE,
    seed: int = 9,
) -> DataFrame:
    """Each query's ``k`` nearest rows found, by Euclidean distance: query_id, rank, vec_id, score;
    ties to the smaller vec_id. ``is_query`` is a condition on vec_id.

    Vectors that are null, hold null or non-finite components, or are zero or empty take no part,
    nor do rows without an id. Vectors of unequal length are continued with zeros. A query's own id
    is no candidate of it. Repeated rows are candidates each, and one query (of the smallest
    vector, if they differ); all copies of a string are found together, however many. With at most
    ``k`` candidates all are found. Other columns are not looked at. An empty table, or one without
    queries, gives no rows.
    """
    return best_of_blocks(
        usable(vectors, vec_id, vector, zero=False), is_query, k,
        lambda ids, rows: Block(ids, rows, k, trees, bits, share, seed),
        "double", True, ROWS_PER_BLOCK, QUERIES_PER_BLOCK,
    )

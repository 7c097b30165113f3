"""Mixing sources to target weights by a min-cost flow over membership patterns.

Documents may belong to several sources. They are counted by membership pattern; words flow from
patterns to the quotas of sources, and each further repetition of a pattern costs more than the one
before, so repeats are spread as evenly as the quotas allow. A pattern's documents then lie end to
end in a seeded order, lap after lap, and the flow takes a run of that line: every document gets
its whole laps, and one of them the part that is left.
"""

from __future__ import annotations

import re
from collections import defaultdict, deque

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.llm.common import WORD, leading_bits, seeded

#: Documents of a pattern that are ordered in one window, about.
ROWS_PER_BUCKET = 2000
_BITS = 30
#: The table of patterns is broadcast up to this many rows; larger ones are joined by a shuffle.
MOST_BROADCAST = 10_000
_WORD = re.compile(WORD)


def water_filled(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight; none above ``most`` times its size, the excess reshared."""
    targets = [0.0] * len(sizes)
    free, rest = [i for i, s in enumerate(sizes)], float(total)
    while free:
        unit = rest / sum(weights[i] for i in free)
        full = [i for i in free if unit * weights[i] > most * sizes[i]]
        if not full:
            for i in free:
                targets[i] = unit * weights[i]
            break
        for i in full:
            targets[i] = float(most * sizes[i])
            rest -= targets[i]
        free = [i for i in free if i not in set(full)]
    return targets


def _components(patterns: list[tuple]) -> list[list[int]]:
    """Patterns that are tied together by common sources."""
    by_source = defaultdict(list)
    for i, pattern in enumerate(patterns):
        for source in pattern:
            by_source[source].append(i)
    seen, groups = set(), []
    for start in range(len(patterns)):
        if start in seen:
            continue
        group, todo = [], [start]
        seen.add(start)
        while todo:
            i = todo.pop()
            group.append(i)
            for source in patterns[i]:
                for j in by_source.pop(source, ()):
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
        groups.append(group)
    return groups


def route(patterns: dict[tuple, int], quotas: dict, most: int) -> dict[tuple, dict]:
    """Words that flow from each pattern to each source.

    Successive shortest paths; the k-th lap over a pattern costs k a word (counted from 0). Each
    component of patterns and sources is a flow of its own.
    """
    names = list(patterns)
    flow = {p: defaultdict(int) for p in names}
    for group in _components(names):
        members = [names[i] for i in group]
        left = {s: quotas[s] for p in members for s in p}
        used = {p: 0 for p in members}

        def lap_cost(p):
            return used[p] // patterns[p] if patterns[p] and used[p] < most * patterns[p] else None

        while True:
            # Cheapest pattern from which an unfilled quota can be reached by moving flows on.
            paths = []
            for p in members:
                if lap_cost(p) is None:
                    continue
                path = _path(p, members, flow, left)
                if path:
                    paths.append((lap_cost(p), len(path), path))
            if not paths:
                break
            _, _, path = min(paths, key=lambda x: x[:2])
            first, last = path[0][0], path[-1][1]
            amount = min(left[last], (used[first] // patterns[first] + 1) * patterns[first] - used[first])
            for (_, source), (taker, _) in zip(path, path[1:]):
                amount = min(amount, flow[taker][source])
            for i, (p, source) in enumerate(path):
                flow[p][source] += amount
                if i:
                    flow[p][path[i - 1][1]] -= amount
            used[first] += amount
            left[last] -= amount
    return flow


def _path(start, members, flow, left):
    """Shortest chain of (pattern, source) steps from a pattern to a source with quota left.

    Inner steps push a source's words from another pattern on to another of that one's sources.
    """
    came, todo, seen = {start: None}, deque([start]), set()
    while todo:
        p = todo.popleft()
        for source in p:
            if source in seen:
                continue
            seen.add(source)
            if left[source] > 0:
                steps = [(p, source)]
                while came[p] is not None:
                    steps.append(came[p])
                    p = came[p][0]
                return steps[::-1]
            for other in members:
                if other not in came and flow[other].get(source, 0) > 0:
                    came[other] = (p, source)
                    todo.append(other)
    return None


def mix(
    docs: DataFrame,
    key: list[Column],
    sources: Column,
    size: Column,
    cycle: tuple[float, ...] = (1, 2, 3),
    most: int = 3,
    seed: int = 1,
) -> DataFrame:
    """Choose words of documents so that sources come to their targets.

    ``sources`` is an array of names (a null name is a source of its own, ordered last), ``size``
    the words of a document, ``key`` the columns that seed the order. Sources ordered by code point
    weigh ``cycle``, repeated; targets are shares of all words, none above ``most`` times its
    source. Returns ``doc`` (the whole row), ``size``, ``taken`` (words, repeats counted) and
    ``shares``, an array of (source, source_size, target, taken).

    A null or negative size is 0. Documents of no words, or of no source, are kept and taken 0
    times. Equal rows are rows of their own and may be taken differently often. An empty table
    gives an empty result. Patterns and sources, not documents, come to the driver: their number is
    that of the mixture's definition.
    """
    spark = docs.sparkSession
    members = F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>"))))
    rows = docs.select(
        F.struct("*").alias("doc"),
        members.alias("members"),
        F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long").alias("size"),
        seeded(seed, *key).alias("place"),
    ).withColumn("pattern", F.to_json("members"))
    counted = rows.groupBy("pattern").agg(
        F.first("members").alias("members"), F.sum("size").alias("words"), F.count("*").alias("n")
    ).collect()

    by_source = defaultdict(int)
    for r in counted:
        for name in r.members:
            by_source[name] += r.words
    names = sorted(by_source, key=lambda x: (x is None, x or ""))
    weights = [cycle[i % len(cycle)] for i in range(len(names))]
    total = sum(r.words for r in counted if r.members)
    targets = dict(zip(names, water_filled([by_source[x] for x in names], weights, total, most)))
    flow = route(
        {tuple(r.members): r.words for r in counted}, {x: round(t) for x, t in targets.items()}, most
    )
    plan = []
    for r in counted:
        at, legs = 0, []
        for name in r.members:
            end = at + flow[tuple(r.members)].get(name, 0)
            legs.append((name, by_source[name], targets[name], at, end))
            at = end
        plan.append((r.pattern, max(1, -(-r.n // ROWS_PER_BUCKET)), r.words, legs))
    patterns = spark.createDataFrame(
        plan,
        "pattern string, buckets long, lap long, legs array<struct<source: string, "
        "source_size: bigint, target: double, first: bigint, last: bigint>>",
    )
    if len(plan) <= MOST_BROADCAST:
        patterns = F.broadcast(patterns)

    dealt = rows.join(patterns.select("pattern", "buckets"), "pattern").withColumn(
        "bucket", F.expr(f"({_bits()} * buckets) div {1 << _BITS}")
    )
    sums = dealt.groupBy("pattern", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sums.select(
        "pattern", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("bucket_start")
    )
    inside = Window.partitionBy("pattern", "bucket").orderBy("place", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = (
        dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, ["pattern", "bucket"])
        .join(patterns.select("pattern", "lap", "legs"), "pattern")
        .withColumn("start", F.expr("bucket_start + inside"))
    )

    def covered(first: str, last: str) -> str:
        """Words of the document inside a run of the pattern's line, over all laps."""
        return " + ".join(
            f"greatest(0L, least(start + {k}L * lap + size, {last}) - greatest(start + {k}L * lap, {first}))"
            for k in range(most)
        )

    return placed.select(
        "doc",
        "size",
        F.expr(f"transform(legs, g -> struct(g.source AS source, g.source_size AS source_size, "
               f"g.target AS target, {covered('g.first', 'g.last')} AS taken))").alias("shares"),
    ).withColumn("taken", F.expr("aggregate(shares, 0L, (a, x) -> a + x.taken)"))


def _bits() -> str:
    return f"shiftrightunsigned(place, {64 - _BITS})"


def _first_words(text: pd.Series, words: pd.Series) -> pd.Series:
    """The texts up to the end of so many words; null where no number is given."""

    def one(whole, count):
        if whole is None or count is None or count != count:
            return None
        for n, word in enumerate(_WORD.finditer(whole), 1):
            if n == count:
                return whole[:word.end()]
        return whole

    return pd.Series([one(*row) for row in zip(text, words)], dtype=object)


def repeated(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mixed documents themselves: whole repeats as rows of their own, a cut one at the end.

    The part of a document that is taken keeps its first words; the others are not in the mix.
    """
    columns = mixed.schema["doc"].dataType.names
    laps = mixed.where("taken > 0").withColumn(
        "words", F.explode(F.expr(
            "concat(array_repeat(size, cast(taken div size AS int)), "
            "filter(array(taken % size), x -> x > 0))"
        ))
    )
    whole = F.col("words") == F.col("size")
    first_words = F.pandas_udf(_first_words, "string")
    cut = first_words(F.when(~whole, F.col(f"doc.`{text}`")), F.when(~whole, F.col("words")))
    return laps.withColumn("cut", cut).select(*[
        (F.when(whole, F.col(f"doc.`{c}`")).otherwise(F.col("cut")) if c == text
         else F.col(f"doc.`{c}`")).alias(c)
        for c in columns
    ])

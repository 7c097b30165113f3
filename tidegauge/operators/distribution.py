"""Exact percentiles of groups of any size.

The built-in exact percentile keeps all distinct values of a group in one buffer. Here a sketch of
bounded size brackets each rank from both sides, by ranks and so in any range of values; a second look
counts the values inside the brackets one by one and those outside together, and only what is inside,
a few thousandths of a group, is ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.text import columns

#: The sketch's ranks are off by at most one in so many.
ACCURACY = 10000
#: A bracket reaches this many errors of the sketch to either side of its rank.
REACH = 4


def _covers(rank: str, start: str) -> str:
    return f"({rank} >= {start} AND {rank} < {start} + _n)"


def bracketed(
    rows: DataFrame, keys: Sequence[str], value: str, percentiles: Mapping[str, float]
) -> DataFrame:
    """Counted values per group: ``_at`` and ``_n``, with the group's own figures on each row.

    A value inside a bracket has a row of its own (``_own``); the values between two brackets share
    one, of which ``_at`` is the least. Nulls are in no row but in the figures.
    """
    shares = sorted(set(percentiles.values()))
    marks = [min(1.0, max(0.0, p + side * REACH / ACCURACY)) for p in shares for side in (-1, 1)]
    number = f"CAST(`{value}` AS DOUBLE)"
    # Values that are no number are the greatest. As marks they count as infinite, and such a mark
    # bounds nothing.
    finite = f"CASE WHEN isnan({number}) THEN double('Infinity') ELSE {number} END"
    renamed = [f"`{k}` AS _k{i}" for i, k in enumerate(keys)]
    figures = rows.groupBy(*keys).agg(
        F.expr("count(1)").alias("_rows"), F.expr(f"count({number})").alias("_valid"),
        F.expr(f"sum({number})").alias("_total"), F.expr(f"min({number})").alias("_low"),
        F.expr(f"max({number})").alias("_high"),
        F.expr(f"percentile_approx({finite}, array({', '.join(f'{m}D' for m in marks)}), {ACCURACY})").alias("_marks"),
    ).selectExpr(*renamed, "_rows", "_valid", "_total", "_low", "_high", "_marks")
    same = " AND ".join(f"`{k}` <=> _k{i}" for i, k in enumerate(keys)) or "true"
    held = rows.selectExpr(*[f"`{k}`" for k in keys], f"{number} AS _v").join(figures, F.expr(same))
    # With fewer values than the sketch tells ranks apart, the nearest marks are the ends of the group.
    few = f"_valid <= {ACCURACY}"
    inside, past = [], []
    for i in range(len(shares)):
        above = f"({few} OR _v >= _marks[{2 * i}])"
        below = f"({few} OR _v <= _marks[{2 * i + 1}] OR _marks[{2 * i + 1}] = double('Infinity'))"
        inside.append(f"({above} AND {below})")
        past.append(f"CAST(NOT {below} AS INT)")
    own = f"(_v IS NOT NULL AND ({' OR '.join(inside) or 'false'}))"
    group = ["_rows", "_valid", "_total", "_low", "_high"]
    return (
        held.selectExpr(
            *[f"`{k}`" for k in keys], *group, "_v", f"{own} AS _own", f"CASE WHEN {own} THEN _v END AS _single",
            f"CASE WHEN _v IS NULL THEN -1 WHEN {own} THEN 0 ELSE {' + '.join(past) or '0'} END AS _gap",
        )
        .groupBy(*keys, "_own", "_single", "_gap")
        .agg(F.expr("min(_v)").alias("_at"), F.expr("count(1)").alias("_n"), *[F.expr(f"max({c})").alias(c) for c in group])
    )


def distribution(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    percentiles: Mapping[str, float],
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per group: avg, min, max, samples and exact interpolated percentiles.

    ``percentiles`` maps output names to fractions; ``names`` renames avg/min/max/samples and
    drops those it leaves out. ``samples`` counts all rows, the rest skips null values.
    """
    names = {n: n for n in ("avg", "min", "max", "samples")} if names is None else names
    keys = list(keys)
    by = columns(keys) or "1"
    # Rows of nulls come first and count as none.
    placed = bracketed(rows, keys, value, percentiles).withColumn("_start", F.expr(
        f"coalesce(sum(CASE WHEN _gap >= 0 THEN _n END) OVER (PARTITION BY {by} ORDER BY _at NULLS FIRST "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"))
    ranks = {name: f"({p}D * (_valid - 1))" for name, p in percentiles.items()}

    def at(name: str, side: str) -> str:
        covered = f"_gap >= 0 AND {_covers(f'{side}({ranks[name]})', '_start')}"
        missed = "raise_error('a rank lies outside its bracket')"
        return f"max(CASE WHEN {covered} THEN CASE WHEN _own THEN _at ELSE CAST({missed} AS DOUBLE) END END)"

    final = placed.groupBy(*keys).agg(
        *[F.expr(f"max({c})").alias(c) for c in ("_valid", "_rows", "_total", "_low", "_high")],
        *[F.expr(at(n, "floor")).alias(f"_{n}_lo") for n in ranks],
        *[F.expr(at(n, "ceil")).alias(f"_{n}_hi") for n in ranks],
    )
    sources = {"avg": "_total / nullif(_valid, 0)", "min": "_low", "max": "_high", "samples": "_rows"}
    return final.selectExpr(
        *[f"`{k}`" for k in keys],
        *[f"{sources[n]} AS `{out}`"
          for n, out in names.items()],
        *[
            f"CASE WHEN _{n}_lo = _{n}_hi THEN _{n}_lo ELSE _{n}_lo + (_{n}_hi - _{n}_lo) * "
            f"({rank} - floor({rank})) END AS `{n}`"
            for n, rank in ranks.items()
        ],
    )

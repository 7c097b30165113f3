"""Shards along a Hilbert curve through several metadata dimensions.

Each dimension is quantised at its own quantiles, rows are ordered by the index of their cell on the
curve, and the order is cut into shards of equal counts. Files then cover small boxes of the
metadata space, and readers that filter on any of the dimensions skip most of them.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidegauge.llm.common import leading_bits, seeded, stored

#: A cell's rows are counted in so many parts (as bits), so that no window holds a whole cell.
_PART_BITS = 12
#: Cells of the curve; the broadcast table is never larger.
MOST_CELLS = 1 << 16


def hilbert_index(axes: tuple[int, ...], bits: int) -> int:
    """Place on the curve of a cell, after Skilling's transform of axes to transposed index."""
    x, n = list(axes), len(axes)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(n):
            if x[i] & level:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0] ^= swap
                x[i] ^= swap
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip, level = 0, 1 << (bits - 1)
    while level > 1:
        if x[n - 1] & level:
            flip ^= level - 1
        level >>= 1
    x = [v ^ flip for v in x]
    index = 0
    for bit in range(bits - 1, -1, -1):
        for v in x:
            index = index << 1 | v >> bit & 1
    return index


def curve(spark: SparkSession, dimensions: int, bits: int) -> DataFrame:
    """The curve as a table: cell code (levels, most significant first) and place."""
    if 1 << dimensions * bits > MOST_CELLS:
        raise ValueError(f"{dimensions} dimensions of {bits} bits make more than {MOST_CELLS} cells")
    rows = []
    for axes in product(range(1 << bits), repeat=dimensions):
        code = 0
        for a in axes:
            code = code << bits | a
        rows.append((code, hilbert_index(axes, bits)))
    return spark.createDataFrame(rows, "cell int, curve_index int")


def text_cuts(docs: DataFrame, dimension: Column, levels: int) -> list[str]:
    """The least text of each level but the first, where texts are ranked by how many rows are before them.

    Distinct texts are counted, laid out in order over many partitions, and ranked by sums within and
    before each; the driver gets a row per level. A text is never cut: its rows share a level.
    """
    counts = stored(
        docs.select(dimension.alias("v")).where("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("n"))
        .repartitionByRange("v").withColumn("run", F.spark_partition_id()), "texts",
    )
    earlier = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.groupBy("run").agg(F.sum("n").alias("in_run")).select(  # a row per partition
        "run", F.coalesce(F.sum("in_run").over(earlier), F.lit(0)).alias("run_start"),
        F.sum("in_run").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("run").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(runs, "run")
    level = F.expr(f"((run_start + before) * {levels}) div total")
    found = ranked.groupBy(level.alias("level")).agg(F.min("v").alias("v")).orderBy("level").collect()
    return [r.v for r in found[1:]]


def shard(
    docs: DataFrame,
    dimensions: list[Column],
    key: list[Column],
    shards: int = 40,
    bits: int = 3,
    seed: int = 6,
) -> DataFrame:
    """Put rows into shards 0 to ``shards - 1`` along the curve, their counts at most one apart.

    ``dimensions`` are numeric or text columns, ``key`` the columns that order rows of one cell. Returns
    ``doc`` (the whole row), ``curve_index``, ``shard`` and ``slot``, gapless from 0 in each shard.

    Numbers are cut at their quantiles, texts by their rank among the distinct ones, whatever they
    begin with. A null dimension lies in the lowest level. Equal rows get places of their own, spread
    over the parts of their cell.
    With fewer rows than shards, some shards stay empty; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    levels = 1 << bits
    steps = F.array(*[F.lit(i / levels) for i in range(1, levels)])
    is_text = [isinstance(f.dataType, T.StringType) for f in docs.select(*dimensions).schema]
    values = [d if text else d.cast("double") for d, text in zip(dimensions, is_text)]
    numbers = [v for v, text in zip(values, is_text) if not text]
    quantiles = iter(docs.agg(
        F.count("*"), *[F.percentile_approx(v, steps, 10000).alias(f"cuts_{i}") for i, v in enumerate(numbers)]
    ).first()[1:])
    code = F.lit(0)
    for v, text in zip(values, is_text):
        if text:
            above = [v >= F.lit(cut) for cut in text_cuts(docs, v, levels)]
        else:
            above = [v > F.lit(cut) for cut in sorted(set(next(quantiles) or ()))]
        level = F.lit(0)
        for condition in above:
            level = level + F.coalesce(condition.cast("int"), F.lit(0))
        code = code * levels + level
    # Written first: the places of equal rows must not change where a task is run again.
    rows = stored(docs.select(
        F.struct("*").alias("doc"), code.alias("cell"),
        seeded(seed, *key, F.monotonically_increasing_id()).alias("place"),
    ), "cells").withColumn("part", leading_bits(F.col("place"), _PART_BITS).cast("int"))
    rows = rows.join(F.broadcast(curve(spark, len(values), bits)), "cell")

    counts = rows.groupBy("curve_index", "part").agg(F.count("*").alias("n"))
    cells = counts.groupBy("curve_index").agg(F.sum("n").alias("n"))
    # One row per cell of the curve: the window holds at most MOST_CELLS rows.
    line = Window.orderBy("curve_index").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(
        "curve_index",
        F.coalesce(F.sum("n").over(line), F.lit(0)).alias("cell_start"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    earlier = Window.partitionBy("curve_index").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    parts = counts.select(
        "curve_index", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start")
    )
    inside = Window.partitionBy("curve_index", "part").orderBy("place")
    ranked = (
        rows.withColumn("inside", F.row_number().over(inside) - 1)
        .join(parts, ["curve_index", "part"])
        .join(starts, "curve_index")
        .withColumn("rank", F.expr("cell_start + part_start + inside"))
        .withColumn("shard", F.expr(f"cast((rank * {shards}) div total AS int)"))
    )
    return ranked.select(
        "doc", "curve_index", "shard",
        F.expr(f"rank - (shard * total + {shards - 1}) div {shards}").alias("slot"),
    )


def write_shards(placed: DataFrame, folder: str, rows_per_file: int = 1_000_000) -> None:
    """Write the rows as Parquet, a folder per shard, in files that are runs of the curve."""
    run = F.floor(F.col("slot") / rows_per_file)
    (
        placed.repartition("shard", run)
        .sortWithinPartitions("shard", "slot")
        .select("doc.*", F.col("shard").alias("curve_shard"))
        .write.partitionBy("curve_shard").parquet(folder)
    )

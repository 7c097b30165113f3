"""Ordered operators that stay spread out when one series holds most of the rows.

A window over a series puts the whole series into one task. Here a series is cut into time slices,
so a window only ever sees one slice. What a slice must know of the past is a single row, the last
one before it; that row is found by a plain aggregation (one row per slice) and handed to the slice
as a carried row. Every row still meets its true predecessor, however long the gap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegauge.functions.text import columns

#: Width of a time slice. 90 days have 2,160 slices, which bounds the carried rows per series.
SLICE_SECONDS = 3600

SLICE = "_slice"
_CARRIED = "_carried"


def slice_of(ts: str, seconds: int) -> Column:
    return F.expr(f"floor(unix_seconds({ts}) / {seconds})")


def with_previous(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    slice_seconds: int = SLICE_SECONDS,
    colocate: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``prev_ts`` and ``prev_value``, the sample before each row of the same key.

    The slice column stays in the result. ``colocate`` names a subset of the keys to shuffle by
    (the slice is added), so that a later grouping by those columns, the slice and more needs no
    shuffle of its own. Of different values at one instant the largest counts as the last one.
    """
    # The rows are shuffled once: the tails are aggregated where their slices lie. They look at every
    # column, so that both readers of the shuffle read the same and Spark runs it for both.
    place = [*(colocate or keys), SLICE]
    sliced = rows.withColumn(SLICE, slice_of(ts, slice_seconds)).repartition(*place)
    tails = sliced.groupBy(*keys, SLICE).agg(
        F.max_by(F.struct(*sliced.columns), F.struct(ts, value)).alias("_tail")
    ).select(*keys, SLICE, *[F.col("_tail")[c].alias(c) for c in (ts, value)])
    by = columns(keys)
    carried = tails.selectExpr(
        *keys, value, ts,
        f"lead({SLICE}) OVER (PARTITION BY {by} ORDER BY {SLICE}) AS {SLICE}",
        f"true AS {_CARRIED}",
    ).filter(f"{SLICE} IS NOT NULL").repartition(*place)
    both = sliced.withColumn(_CARRIED, F.lit(False)).unionByName(
        carried, allowMissingColumns=True
    )
    # The slice leads the sort: a number that tells most rows apart without comparing text.
    order = f"OVER (PARTITION BY {SLICE}, {by} ORDER BY {ts}, {value})"
    return (
        both.selectExpr("*", f"lag({ts}) {order} AS prev_ts", f"lag({value}) {order} AS prev_value")
        .filter(f"NOT {_CARRIED}")
        .drop(_CARRIED)
    )


def latest_before(
    rows: DataFrame,
    marks: DataFrame,
    keys: Sequence[str],
    payload: Sequence[str] = (),
    ts: str = "ts",
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """As-of match: add ``mark_ts`` and the mark's payload, the newest mark at or before each row.

    Rows without an earlier mark keep nulls. Both inputs have the keys and ``ts``. Of several marks
    at one instant the one with the largest payload counts.
    """
    info = ["mark_ts", *payload]
    rows_in = rows.withColumn(SLICE, slice_of(ts, slice_seconds))
    marks_in = marks.select(
        *keys, ts, *payload, F.col(ts).alias("mark_ts"),
        slice_of(ts, slice_seconds).alias(SLICE),
    )
    # A mark travels as one struct, so that a null in its payload stays its own.
    tails = marks_in.groupBy(*keys, SLICE).agg(
        F.max(F.struct(ts, *info)).alias("_tail")
    ).select(*keys, SLICE, F.struct(*[F.col("_tail")[c].alias(c) for c in info]).alias("_mark"))
    slices = rows_in.select(*keys, SLICE).distinct().withColumn("_asks", F.lit(True))
    # By the slice's number and not by place, so that a slice does not see its own tail.
    before = W.partitionBy(*keys).orderBy(SLICE).rangeBetween(W.unboundedPreceding, -1)
    carried = (
        slices.unionByName(tails, allowMissingColumns=True)
        .withColumn("_mark", F.last("_mark", ignorenulls=True).over(before))
        .filter(F.col("_asks") & F.col("_mark").isNotNull())
        .select(*keys, SLICE, "_mark.*")
        .withColumn(ts, F.col("mark_ts"))
    )
    both = (
        rows_in.withColumn("_row", F.lit(True))
        .unionByName(marks_in.withColumn("_row", F.lit(False)), allowMissingColumns=True)
        .unionByName(carried.withColumn("_row", F.lit(False)), allowMissingColumns=True)
    )
    upto = (
        W.partitionBy(SLICE, *keys)
        .orderBy(ts, "_row", *payload)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    mark = F.when(~F.col("_row"), F.struct(*info))
    return (
        both.withColumn("_mark", F.last(mark, ignorenulls=True).over(upto))
        .filter("_row")
        .select(*rows.columns, *[F.col("_mark")[name].alias(name) for name in info])
    )

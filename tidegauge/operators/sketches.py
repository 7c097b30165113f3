"""Mergeable quantiles and distinct counts, kept in rollups.

A rollup row holds two sketches beside its counts. Sketches of short bins merge to those of any longer
bin, so a question over months reads rollup rows and no samples. Answers are approximate: a quantile's
rank lies within ``RANK_ERROR`` of the one asked for, a distinct count within ``DISTINCT_ERROR`` of the
true one, both with a probability of over 99 %.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.timing import bin_start

#: Size of the quantile sketch, and the error of a rank that follows from it, as a share of all values.
QUANTILE_K, RANK_ERROR = 400, 0.015
#: Size of the distinct sketch as a power of two, and three times its relative standard error.
DISTINCT_LG_K, DISTINCT_ERROR = 12, 0.05


def sketched(
    rows: DataFrame, keys: Sequence[str], value: Column | None = None, counted: Column | None = None,
    seconds: int = 300, ts: str = "ts",
) -> DataFrame:
    """A row per bin and key: ``samples``, and the sketches of ``value`` and of ``counted``.

    Nulls, and values that are no number, are in no sketch but count as samples. A bin without any value
    has a null sketch. ``counted`` may be of any type; it is told apart by its text.
    """
    columns = [F.count(F.lit(1)).alias("samples")]
    if value is not None:
        number = F.when(~F.isnan(value.cast("double")), value.cast("double"))
        columns += [
            F.count(number).alias("valued"), F.min(number).alias("min"), F.max(number).alias("max"),
            F.when(F.count(number) > 0, F.kll_sketch_agg_double(number, QUANTILE_K)).alias("quantiles"),
        ]
    if counted is not None:
        columns.append(F.hll_sketch_agg(counted.cast("string"), DISTINCT_LG_K).alias("distinct"))
    return rows.groupBy(bin_start(F.col(ts), seconds).alias("ts"), *keys).agg(*columns)


def merged(rollup: DataFrame, keys: Sequence[str], seconds: int | None = None) -> DataFrame:
    """The rollup in longer bins, or over all times where ``seconds`` is None (then without ``ts``).

    Used too to merge partial rows of one bin, with the same ``seconds``.
    """
    how = {
        "samples": F.sum("samples"), "valued": F.sum("valued"), "min": F.min("min"), "max": F.max("max"),
        "quantiles": F.kll_merge_agg_double("quantiles"), "distinct": F.hll_union_agg("distinct"),
    }
    bins = [] if seconds is None else [bin_start(F.col("ts"), seconds).alias("ts")]
    if "quantiles" in rollup.columns:
        how["quantiles"] = F.when(F.sum("valued") > 0, how["quantiles"])
    found = [column.alias(name) for name, column in how.items() if name in rollup.columns]
    return rollup.groupBy(*bins, *keys).agg(*found)


def answers(rollup: DataFrame, quantiles: Mapping[str, float] | None = None) -> DataFrame:
    """The rollup with its sketches replaced by ``distinct_values`` and the quantiles asked for, by name."""
    kept = [c for c in rollup.columns if c not in ("quantiles", "distinct")]
    told = []
    if "distinct" in rollup.columns:
        told.append(F.hll_sketch_estimate("distinct").alias("distinct_values"))
    for name, share in (quantiles or {}).items():
        told.append(F.when(
            F.col("quantiles").isNotNull(), F.kll_sketch_get_quantile_double("quantiles", F.lit(share))
        ).alias(name))
    return rollup.select(*kept, *told)

"""Rates of cumulative counters, safe across counter resets.

Time bounds are inclusive and apply before the previous sample is looked up, so the first sample
in range has no rate. A falling counter has no rate either; the sample after it is compared with
the fallen one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.text import listed, literal
from tidegauge.functions.timing import whole_seconds
from tidegauge.operators.ordered import SLICE, SLICE_SECONDS, latest_before, with_previous

SERIES_KEYS = ("series_key", "field", "target_id", "run_id", "measurement")
LEGACY_KEYS = ("run_id", "host", "metric")


def between(start=None, end=None, ts: str = "ts") -> Column:
    """Inclusive time range; a bound of None is open. Bounds are datetimes or timestamp text."""
    tests = [
        f"{ts} {sign} CAST({literal(bound)} AS TIMESTAMP)"
        for sign, bound in ((">=", start), ("<=", end))
        if bound is not None
    ]
    return F.expr(" AND ".join(tests) or "true")


def wanted_fields(fields: Mapping[str, Sequence[str]]) -> Column:
    """Rows of the given fields, keyed by measurement."""
    return F.expr(" OR ".join(
        f"(measurement = {literal(measurement)} AND field IN ({listed(names)}))"
        for measurement, names in fields.items()
    ))


def counter_rate(
    metrics: DataFrame, metric: str, run_id: str, start=None, end=None,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Per-second rate of one metric of the legacy table, per host, in whole seconds."""
    chosen = metrics.filter(
        between(start, end) & (F.col("metric") == metric) & (F.col("run_id") == run_id)
    ).select("ts", "run_id", "host", "tier", "metric", "value")
    seconds = whole_seconds(F.col("ts"), F.col("prev_ts"))
    delta = F.col("value") - F.col("prev_value")
    return (
        with_previous(chosen, LEGACY_KEYS, slice_seconds=slice_seconds)
        .filter((seconds > 0) & (delta >= 0))
        .select("ts", "host", "tier", "metric", (delta / seconds).alias("rate"))
    )


def multi_rate(
    series: DataFrame,
    fields: Mapping[str, Sequence[str]],
    runs: Sequence[str],
    start=None,
    end=None,
    targets: Sequence[str] | None = None,
    slice_seconds: int = SLICE_SECONDS,
    colocate: Sequence[str] | None = None,
    where: Column | None = None,
    dimensions: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rates of several counter fields and runs from one scan and one pass over the series.

    ``where`` may only test what is fixed for a series (tags, host, tier): it drops whole series
    before the shuffle. ``dimensions`` replaces the tags, a map, by the few columns a caller
    needs of it.
    """
    chosen = series.filter(
        wanted_fields(fields) & F.col("run_id").isin(*runs) & between(start, end)
    )
    if targets is not None:
        chosen = chosen.filter(F.col("target_id").isin(*targets))
    if where is not None:
        chosen = chosen.filter(where)
    kept = {"tags": F.col("tags")} if dimensions is None else dimensions
    chosen = chosen.select(
        "ts", *SERIES_KEYS, "host", "tier", *[c.alias(n) for n, c in kept.items()], "value"
    )
    paired = with_previous(chosen, SERIES_KEYS, slice_seconds=slice_seconds, colocate=colocate)
    return _rates(paired, list(kept))


def _rates(paired: DataFrame, kept: Sequence[str]) -> DataFrame:
    seconds = "((unix_millis(ts) - unix_millis(prev_ts)) / 1000D)"
    delta = "(value - prev_value)"
    return paired.filter(f"{seconds} > 0 AND {delta} >= 0").selectExpr(
        "ts", "run_id", "target_id", "host", "tier", "measurement", "field", "series_key", *kept,
        f"{delta} AS delta", f"{seconds} AS seconds", f"{delta} / {seconds} AS rate", SLICE,
    )


def metric_series_rate(
    series: DataFrame, measurement: str, field: str, run_id: str, start=None, end=None,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Per-second rate and delta of one catalog counter, per target and series."""
    return multi_rate(
        series, {measurement: [field]}, [run_id], start, end, slice_seconds=slice_seconds
    ).drop(SLICE)


def counter_resets(
    series: DataFrame, fields: Mapping[str, Sequence[str]], runs: Sequence[str],
    start=None, end=None, slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """The samples at which a counter fell, which the rates leave out."""
    chosen = series.filter(
        wanted_fields(fields) & F.col("run_id").isin(*runs) & between(start, end)
    ).select("ts", *SERIES_KEYS, "host", "value")
    return (
        with_previous(chosen, SERIES_KEYS, slice_seconds=slice_seconds)
        .filter(F.col("value") < F.col("prev_value"))
        .drop(SLICE)
    )


def explain_resets(
    resets: DataFrame, restarts: DataFrame, within_seconds: int,
    keys: Sequence[str] = ("host",), slice_seconds: int = 86400,
) -> DataFrame:
    """Attach the newest restart at or before each reset; ``explained`` if it is recent enough."""
    matched = latest_before(
        resets, restarts, keys, payload=["operation"], slice_seconds=slice_seconds
    )
    age = whole_seconds(F.col("ts"), F.col("mark_ts"))
    return (
        matched.withColumn("explained", F.coalesce(age <= within_seconds, F.lit(False)))
        .withColumnRenamed("mark_ts", "restart_ts")
    )

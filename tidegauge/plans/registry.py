"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from tidegauge.plans.fixture_sql import with_tables
from tidegauge.plans.fixtures import END, START, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Doubles are compared with this many decimals: two engines add them in different orders.
DECIMALS = 6

RANGE = f"ts BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"


@lru_cache(maxsize=16)
def tables(spark: SparkSession, folder: str) -> Tables:
    """Frames are only plans, so one set per session and folder serves all queries."""
    return Tables(spark, folder)


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    """Register a function of ``Tables``; double columns are rounded on both sides."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return rounded(build(tables(spark, folder)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql, extra)
        return build

    return register


def rounded(frame: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    return frame.selectExpr(*[
        f"round(`{c}`, {decimals}) + 0e0 AS `{c}`" if t == "double" else f"`{c}`"
        for c, t in frame.dtypes
    ])


def r(expression: str, name: str) -> str:
    """A rounded double column of the checking SQL."""
    return f"round({expression}, {DECIMALS}) + 0e0 AS {name}"


def half_up(expression: str, decimals: int) -> str:
    """Decimal rounding of the checking SQL, as Spark rounds a double."""
    return f"CAST(round(CAST({expression} AS DECIMAL(28, 12)), {decimals}) AS DOUBLE)"


def rate_tables(where: str, source: str = "series") -> dict[str, str]:
    """Table expressions ``paired`` (sample with its previous one) and ``rates``."""
    return {
        "paired": f"""
            SELECT *, value - prev_value AS delta,
                   (epoch_us(ts) // 1000 - epoch_us(prev_ts) // 1000) / 1000e0 AS seconds
            FROM (SELECT *, lag(ts) OVER w AS prev_ts, lag(value) OVER w AS prev_value
                  FROM {source} WHERE {where} AND {RANGE}
                  WINDOW w AS (PARTITION BY run_id, target_id, measurement, field, series_key
                               ORDER BY ts, value))
        """,
        "rates": "SELECT *, delta / seconds AS rate FROM paired WHERE seconds > 0 AND delta >= 0",
    }


def field_is(measurement: str, *fields: str) -> str:
    names = ", ".join(f"'{f}'" for f in fields)
    return f"measurement = '{measurement}' AND field IN ({names})"

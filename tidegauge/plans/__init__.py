"""Registered queries over the test tables."""

from tidegauge.plans import (  # noqa: F401
    benchmark_queries,
    contract_queries,
    panel_queries,
    platform_queries,
    rate_queries,
    source_queries,
)
from tidegauge.plans.registry import ORACLES, QUERIES  # noqa: F401

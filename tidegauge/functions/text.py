"""SQL text of values. Long expressions are written as SQL: one call instead of dozens."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(text: Column) -> Column:
    """Whether a text holds more than white space of any kind; null does not."""
    return F.coalesce(text.rlike(r"[^\s\p{Z}\x{1C}-\x{1F}\x{85}]"), F.lit(False))


def literal(value: str | datetime) -> str:
    """A SQL literal. Timestamp text is taken as UTC, the session's time zone."""
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def listed(values: Iterable[str]) -> str:
    return ", ".join(literal(v) for v in values)


def columns(names: Iterable[str], prefix: str = "") -> str:
    return ", ".join(f"{prefix}`{n}`" for n in names)

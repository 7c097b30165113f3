"""Time expressions. The session time zone is UTC throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: wire form of a timestamp, UTC with microseconds and an explicit Z.
WIRE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def utc_iso(ts: Column) -> Column:
    return F.date_format(ts, WIRE_FORMAT)


def bin_start(ts: Column, seconds: int) -> Column:
    """Start of the epoch-aligned bin of the given width."""
    epoch = F.unix_seconds(ts)
    return F.timestamp_seconds(epoch - F.pmod(epoch, F.lit(seconds)))


def whole_seconds(later: Column, earlier: Column) -> Column:
    """Number of second borders crossed, not elapsed time: 0.9 s to 2.1 s counts 2."""
    return F.unix_seconds(later) - F.unix_seconds(earlier)


def has_utc_offset(text: Column) -> Column:
    """Whether timestamp text names its offset (Z or +hh:mm); text without one is naive."""
    return text.rlike(r"(Z|z|[+-]\d{2}:?\d{2})$")


def parse_instant(text: Column) -> Column:
    """Timestamp of wire text, null when it is malformed or names no offset."""
    return F.when(has_utc_offset(text), F.try_to_timestamp(text))

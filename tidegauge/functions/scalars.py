"""Number parsing and whole-term search."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = r"[0-9](?:_?[0-9])*"
_DECIMAL = (
    rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
)
_SPECIAL = r"(?i)^[+-]?(?:inf|infinity|nan)$"


def parse_double(text: Column) -> Column:
    """Number in text, or null.

    Accepts digit-group underscores, nan and inf; refuses the 1d and 1f suffixes that a bare cast
    would take.
    """
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(
        trimmed.rlike(_DECIMAL), F.regexp_replace(trimmed, "_", "").try_cast("double")
    ).when(trimmed.rlike(_SPECIAL), trimmed.try_cast("double"))


def relative_difference(left: Column, right: Column) -> Column:
    """Difference in percent of the larger magnitude; 0 when both are 0."""
    larger = F.greatest(F.abs(left), F.abs(right))
    return F.when(larger == 0, F.lit(0.0)).otherwise(
        F.lit(100.0) * F.abs(left - right) / larger
    )


def has_term(text: Column, *terms: str) -> Column:
    """Whether any term occurs as a whole word, ignoring case."""
    return text.rlike(rf"(?i)(^|[^\p{{L}}\p{{N}}])({'|'.join(terms)})([^\p{{L}}\p{{N}}]|$)")


def filled(text: Column, default: str) -> Column:
    """Text, or the default where it is null or empty."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))

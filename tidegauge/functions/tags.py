"""Tag access and series identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Identity is the first 24 hex digits of SHA-256 over canonical JSON.
SERIES_KEY_DIGITS = 24

_PLAIN = r'^[ !#-\[\]-~]*$'


def tag(name: str, tags: str | Column = "tags") -> Column:
    """Tag value as text; a missing tag is the empty string, never null."""
    column = F.col(tags) if isinstance(tags, str) else tags
    return F.coalesce(column.getItem(name), F.lit(""))


def json_text(text: Column) -> Column:
    """JSON string literal in pure ASCII with lower-case hex escapes.

    Text of plain printable characters, nearly all of it, only gains quotes. Anything else is
    escaped character by character.
    """
    return F.when(
        text.rlike(_PLAIN), F.concat(F.lit('"'), text, F.lit('"'))
    ).otherwise(
        F.concat(
            F.lit('"'),
            F.array_join(
                F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), _escaped), ""
            ),
            F.lit('"'),
        )
    )


def _escaped(char: Column) -> Column:
    units = F.lower(F.hex(F.encode(char, "UTF-16BE")))
    return (
        F.when(char == F.lit('"'), F.lit('\\"'))
        .when(char == F.lit("\\"), F.lit("\\\\"))
        .when(char == F.lit("\n"), F.lit("\\n"))
        .when(char == F.lit("\r"), F.lit("\\r"))
        .when(char == F.lit("\t"), F.lit("\\t"))
        .when(char == F.lit("\b"), F.lit("\\b"))
        .when(char == F.lit("\f"), F.lit("\\f"))
        .when(char.rlike("^[ -~]$"), char)
        .otherwise(F.regexp_replace(units, "([0-9a-f]{4})", r"\\u$1"))
    )


def canonical_tags(tags: Column) -> Column:
    """JSON object of the tags, sorted by name, without blanks."""
    pairs = F.transform(
        F.array_sort(F.map_entries(tags)),
        lambda pair: F.concat(json_text(pair["key"]), F.lit(":"), json_text(pair["value"])),
    )
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def series_key(target_id: Column, measurement: Column, tags: Column) -> Column:
    """Stable identity of one measurement and tag combination of a target."""
    canonical = F.concat(
        F.lit('{"measurement":'),
        json_text(measurement),
        F.lit(',"tags":'),
        canonical_tags(tags),
        F.lit(',"target_id":'),
        json_text(target_id),
        F.lit("}"),
    )
    return F.substring(F.sha2(canonical, 256), 1, SERIES_KEY_DIGITS)


def label(*parts: Column) -> Column:
    """Legend text of a panel: parts joined by a spaced slash."""
    return F.concat_ws(" / ", *parts)

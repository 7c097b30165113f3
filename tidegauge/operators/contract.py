"""The point contract: checks, identity and projections.

A point is a row of context columns, ``ts``, ``measurement``, ``tags`` (map of text) and
``fields`` (map of variants). A point before its checks may carry ``ts`` as wire text. All checks
are expressions on one row; the catalog has ten rows and is always broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.catalog import catalog_frame, field_frame
from tidegauge.functions.tags import series_key
from tidegauge.functions.text import filled
from tidegauge.functions.timing import has_utc_offset, parse_instant, utc_iso
from tidegauge.operators.audits import CONTRACT_VERSION
from tidegauge.schemas import POINTS, SERIES, WIRE_NAMES

#: Context that must not be blank.
REQUIRED_CONTEXT = ("run_id", "target_id", "host", "tier")

_SPEC_COLUMNS = ("known_tags", "known_fields", "required_fields", "specs")


def value_type(value: Column) -> Column:
    """Type of a variant in contract words. Truth values are not integers."""

    def word(name: Column) -> Column:
        wide_integer = name.rlike(r"^DECIMAL\((19|[23]\d),0\)$")
        return (
            F.when(name == "BOOLEAN", "bool")
            .when((name == "BIGINT") | wide_integer, "int")
            .when(name.startswith("DECIMAL") | (name == "DOUBLE") | (name == "FLOAT"), "float")
            .when(name == "STRING", "str")
            .when(name == "VOID", "NoneType")
            .when(name.startswith("ARRAY"), "list")
            .otherwise("dict")
        )

    # As an element, the type's name is computed once and not once for each of its uses.
    return F.get(F.transform(F.array(F.schema_of_variant(value)), word), F.lit(0))


def is_number(value: Column) -> Column:
    """Whether a variant is a number; a truth value is none."""
    return F.schema_of_variant(value).rlike(r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)")


#: A number of 19 digits or more whose fraction is zero: as a variant it looks like a whole number.
_WIDE_REAL = r"[0-9]{19,}\.0+"


def exact_kinds(fields: Column, text: Column, raw: Column) -> Column:
    """Fields (a map of variants) in which wide real numbers are real.

    ``text`` is the JSON text the fields were read from, ``raw`` the map of the same fields as texts, in
    which a real number keeps a point or an exponent. It is only computed where the text holds such a
    number.
    """
    wide = F.coalesce(text.rlike(_WIDE_REAL + r"([^0-9eE]|$)"), F.lit(False))

    def retyped(name: Column, value: Column) -> Column:
        own = raw[name]
        return F.when(
            F.schema_of_variant(value).startswith("DECIMAL") & own.rlike("[.eE]"),
            F.try_parse_json(own),
        ).otherwise(value)

    return F.when(wide, F.transform_values(fields, retyped)).otherwise(fields)


def invariant_problem(naive: Column | None = None) -> Column:
    """First broken rule that needs no catalog, or null.

    ``naive`` is the condition that the observation time names no offset.
    """
    blank = [F.when(~filled(F.col(c)), F.lit(c)) for c in REQUIRED_CONTEXT]
    missing = F.array_join(F.array_compact(F.array(*blank)), ", ")
    measurement = F.coalesce(F.col("measurement"), F.lit(""))
    names = F.map_keys("fields")
    bad_tag = F.exists(
        F.map_entries("tags"), lambda e: (e["key"] == "") | e["value"].isNull()
    )
    untimed = F.col("ts").isNull() if naive is None else naive
    # The texts of problems, here and below, by which callers tell them apart.
    return (
        F.when(missing != "", F.concat(F.lit("telemetry context requires: "), missing))
        .when(untimed, "observed_at must be timezone-aware")
        .when(measurement == "", "measurement must not be empty")
        .when(
            F.coalesce(F.size(names), F.lit(0)) <= 0,
            F.concat(measurement, F.lit(" must contain at least one field")),
        )
        .when(
            F.array_contains(names, ""),
            F.concat(measurement, F.lit(" contains an empty field name")),
        )
        .when(bad_tag, F.concat(measurement, F.lit(" tags require non-empty names and values")))
    )


def _catalog_problem() -> Column:
    """First broken catalog rule of a row joined with its measurement's specification."""
    field_names, tag_names = F.map_keys("fields"), F.map_keys("tags")
    checks = {
        "unknown fields: ": F.array_except(field_names, F.col("known_fields")),
        "missing fields: ": F.array_except(F.col("required_fields"), field_names),
        "unknown tags: ": F.array_except(tag_names, F.col("known_tags")),
        "missing tags: ": F.array_except(F.col("known_tags"), tag_names),
    }
    parts = F.array_join(
        F.array_compact(F.array(*[
            F.when(F.size(names) > 0,
                   F.concat(F.lit(text), F.array_join(F.array_sort(names), ", ")))
            for text, names in checks.items()
        ])),
        "; ",
    )

    def wrong(entry: Column) -> Column:
        wanted, found = F.col("specs")[entry["key"]]["value_type"], value_type(entry["value"])
        fits = (wanted == found) | ((wanted == "float") & (found == "int"))
        return F.when(
            ~fits,
            F.concat(F.col("measurement"), F.lit("."), entry["key"], F.lit(" expects "), wanted,
                     F.lit(", got "), found),
        )

    mistyped = F.get(F.array_compact(F.transform(F.map_entries("fields"), wrong)), F.lit(0))
    return (
        F.when(
            F.col("known_fields").isNull(),
            F.concat(F.lit("unknown measurement '"), F.col("measurement"), F.lit("'")),
        )
        .when(parts != "", F.concat(F.col("measurement"), F.lit(": "), parts))
        .otherwise(mistyped)
    )


def check_points(points: DataFrame, naive: Column | None = None) -> DataFrame:
    """Add ``problem``: why the point breaks the contract, or null for a valid one."""
    catalog = F.broadcast(catalog_frame(points.sparkSession))
    return (
        points.join(catalog, "measurement", "left")
        .withColumn("problem", F.coalesce(invariant_problem(naive), _catalog_problem()))
        .select(*points.columns, "problem")
    )


def split_points(points: DataFrame, naive: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid points, and rejected ones with their ``problem``."""
    checked = check_points(points, naive)
    valid = checked.filter(F.col("problem").isNull()).drop("problem")
    return valid, checked.filter(F.col("problem").isNotNull())


def naive_text(ts_text: str = "ts") -> Column:
    """Whether wire text names no offset; missing text counts as naive too."""
    return ~F.coalesce(has_utc_offset(F.col(ts_text)), F.lit(False))


def point_from_row(rows: DataFrame) -> DataFrame:
    """Points of wire rows: parsed time, tags as text, empty optional context."""
    renamed = rows
    for column, wire in WIRE_NAMES.items():
        if wire in rows.columns:
            renamed = renamed.withColumnRenamed(wire, column)
    for optional in ("resource_id", "collector_id"):
        present = F.col(optional) if optional in renamed.columns else F.lit(None)
        renamed = renamed.withColumn(optional, F.coalesce(present, F.lit("")))
    return renamed.withColumn("ts", parse_instant(F.col("ts")))


def packed_row(points: DataFrame) -> DataFrame:
    """Canonical columns of a point, with its version and series identity."""
    return (
        points.withColumn("contract_version", F.lit(CONTRACT_VERSION))
        .withColumn(
            "series_key", series_key(F.col("target_id"), F.col("measurement"), F.col("tags"))
        )
        .select(*POINTS.fieldNames())
    )


def wire_text(columns: Sequence[str], instead: Mapping[str, Column] | None = None) -> Column:
    """The JSON text of a row's columns, some of them replaced by other values."""
    values = {c: utc_iso(F.col(c)) if c == "ts" else F.col(c) for c in columns} | dict(instead or {})
    return F.to_json(F.struct(*[values[c].alias(WIRE_NAMES.get(c, c)) for c in columns]))


def wire_row(packed: DataFrame) -> DataFrame:
    """One JSON text per packed row."""
    return packed.select(wire_text(packed.columns).alias("value"))


def _numbers(points: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """A row per numeric field, of those ``wanted`` if given, before any value is looked at."""
    entries = points.select(*points.columns, F.explode("fields").alias("field", "variant"))
    if wanted is not None:
        entries = entries.join(F.broadcast(wanted), ["measurement", "field"])
    return entries.filter(is_number(F.col("variant"))).withColumn(
        "value", F.try_variant_get("variant", "$", "double"))


def series_rows(packed: DataFrame) -> DataFrame:
    """Narrow rows of the numeric fields that the catalog projects to series."""
    fields = (
        field_frame(packed.sparkSession)
        .filter("series")
        .select("measurement", "field", "kind", "unit")
    )
    return _numbers(packed, fields).select(*SERIES.fieldNames())


def legacy_metric_rows(
    points: DataFrame, source: str, names: Mapping[str, str] | None = None
) -> DataFrame:
    """Legacy rows of untagged points; one that has tags or breaks the contract fails the job."""
    tagged = F.when(F.size("tags") > 0, F.concat(
        F.col("measurement"), F.lit(" has tags and cannot be represented by the legacy metric table")
    ))
    refused = F.coalesce("problem", tagged)
    untagged = check_points(points).filter(
        F.when(refused.isNull(), F.lit(True)).otherwise(F.raise_error(refused).cast("boolean"))
    ).drop("problem")
    metric = F.col("field")
    for field, renamed in (names or {}).items():
        metric = F.when(F.col("field") == field, F.lit(renamed)).otherwise(metric)
    return _numbers(untagged).select(
        "ts", "run_id", "host", "tier", F.lit(source).alias("source"), metric.alias("metric"),
        "value",
    )

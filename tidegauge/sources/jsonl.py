"""JSON Lines archives: typed reads, checked loads and appends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.text import filled
from tidegauge.operators.contract import (
    check_points,
    exact_kinds,
    naive_text,
    packed_row,
    point_from_row,
    series_rows,
    wire_row,
)
from tidegauge.schemas import EVENTS, METRICS, POINTS, SERIES, WIRE_NAMES, wire_schema


#: Characters of a failing line that the message of a strict load shows.
MESSAGE_CHARACTERS = 200


class ArchiveError(ValueError):
    """An archive without any telemetry row."""


_BROKEN = "_broken_line"


def _lines(spark: SparkSession, path: str, table: T.StructType) -> DataFrame:
    """Lines that are not blank (``value``), with their file and their wire row; its last field is
    the text of a line that is no such row, null for all others."""
    wire = T.StructType([*wire_schema(table).fields, T.StructField(_BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    return spark.read.text(path).filter(filled(F.col("value"))).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.from_json("value", wire, options).alias("row"),
    )


def _read(spark: SparkSession, path: str, table: T.StructType) -> DataFrame:
    """Rows of a table from its wire form; keys that a line lacks, and times that cannot be read,
    become null. Lines that are no row are left to ``read_rejects``."""
    columns = [
        F.try_to_timestamp("row.ts").alias("ts") if f.name == "ts"
        else F.col(f"row.{WIRE_NAMES.get(f.name, f.name)}").alias(f.name)
        for f in table.fields
    ]
    return _lines(spark, path, table).filter(F.col(f"row.{_BROKEN}").isNull()).select(*columns)


def read_rejects(spark: SparkSession, path: str, table: T.StructType) -> DataFrame:
    """The lines that are no row of the table (``value``), with their file."""
    return _lines(spark, path, table).filter(F.col(f"row.{_BROKEN}").isNotNull()).select("file", "value")


def read_telemetry_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, POINTS)


def read_series_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, SERIES)


def read_metrics_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, METRICS)


def read_events_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, EVENTS)


#: Rows of one archive file at most; a compressed file is read by one task.
ROWS_PER_FILE = 500_000


def write_jsonl(rows: DataFrame, path: str) -> None:
    """Append table rows in wire form, one JSON object per line, gzipped; existing files stay.

    Every line repeats the names of its keys, so the text is many times as large as what it says.
    """
    write_lines(wire_row(rows), path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Append text lines (``value``) as gzipped files of bounded size."""
    lines.write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).text(path, compression="gzip")


def write_telemetry_jsonl(points: DataFrame, path: str) -> None:
    """Append points as canonical rows."""
    write_jsonl(packed_row(points), path)


#: A wire row as it arrives: tag values of any type, fields kept apart by name.
_ARRIVING = T.StructType([
    T.StructField("tags", T.MapType(T.StringType(), T.VariantType())) if f.name == "tags" else f
    for f in wire_schema(POINTS).fields
])
# Keys without which a line is no telemetry row.
REQUIRED_KEYS = ("ts", "run_id", "target_id", "host", "tier", "measurement", "tags", "fields")


def _tag_text(value: Column) -> Column:
    """Tag value as text, in the words the archive writer uses for null and truth values."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(kind == "VOID", "None")
        .when(kind == "BOOLEAN", F.initcap(text))
        .otherwise(text)
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """Points of text lines (``value``), with ``problem`` set on those that are not valid.

    All other columns of the lines, such as their file, stay.
    """
    kept = [c for c in lines.columns if c != "value"]
    parsed = lines.filter(filled(F.col("value"))).withColumn(
        "_row", F.from_json("value", _ARRIVING, {"mode": "PERMISSIVE"})
    )
    missing = F.array_compact(F.array(*[
        F.when(F.col(f"_row.{key}").isNull(), F.lit(key)) for key in REQUIRED_KEYS
    ]))
    malformed = F.try_parse_json("value").isNull()
    unreadable = F.when(malformed, "malformed JSON").when(
        F.size(missing) > 0, F.concat(F.lit("missing key: "), F.array_join(missing, ", "))
    )
    rows = parsed.select(
        *kept, "value", unreadable.alias("_unreadable"), F.col("_row.ts").alias("_ts_text"),
        *[F.col(f"_row.{f.name}").alias(f.name) for f in _ARRIVING.fields],
    ).withColumns({
        "tags": F.transform_values("tags", lambda _, v: _tag_text(v)),
        "fields": exact_kinds(
            F.col("fields"), F.col("value"), F.from_json("value", "fields map<string,string>")["fields"]),
    })
    checked = check_points(point_from_row(rows), naive_text("_ts_text"))
    late = F.when(F.col("ts").isNull(), "unreadable timestamp")
    return checked.withColumn("problem", F.coalesce("_unreadable", "problem", late)).drop(
        "_unreadable", "_ts_text"
    )


def load_archive(
    spark: SparkSession, path: str, strict: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Packed rows, series rows and rejects of an archive.

    Strict loads fail on the first invalid line, naming its file and text, when the rows are
    used; permissive loads return such lines with their file and problem. An archive without any
    line is an error.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    if lines.filter(filled(F.col("value"))).isEmpty():
        raise ArchiveError(f"{path} contains no telemetry rows")
    checked = parse_lines(lines)
    invalid = F.col("problem").isNotNull()
    if strict:
        failure = F.raise_error(
            F.concat(F.col("file"), F.lit(": invalid telemetry row: "), F.col("problem"),
                     F.lit(": "), F.substring("value", 1, MESSAGE_CHARACTERS))
        ).cast("boolean")
        valid = checked.filter(F.when(~invalid, F.lit(True)).otherwise(failure))
    else:
        valid = checked.filter(~invalid)
    packed = packed_row(valid)
    return packed, series_rows(packed), checked.filter(invalid).select("file", "problem", "value")


def write_rejects(rejects: DataFrame, path: str) -> None:
    rejects.write.mode("append").json(path)



"""Scans of exported platform tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.schemas import PLATFORM_NAMES, PLATFORM_TABLES


def read_platform(
    spark: SparkSession, table: str, path: str, file_format: str = "parquet"
) -> DataFrame:
    """Table "metrics", "diagnostics" or "activity" under its pinned schema and our names."""
    layout, names = PLATFORM_TABLES[table], PLATFORM_NAMES[table]
    wire = T.StructType([
        T.StructField(name, field.dataType) for name, field in zip(names, layout.fields)
    ])
    rows = spark.read.schema(wire).format(file_format).load(path)
    return rows.select(*[
        F.col(name).alias(field.name) for name, field in zip(names, layout.fields)
    ])


def write_platform(frame: DataFrame, table: str, path: str, file_format: str = "parquet") -> None:
    """Export a frame under the platform's column names."""
    layout, names = PLATFORM_TABLES[table], PLATFORM_NAMES[table]
    missing = {
        f.name: F.lit(None).cast(f.dataType) for f in layout.fields if f.name not in frame.columns
    }
    filled = frame.withColumns(missing) if missing else frame
    filled.select(*[
        F.col(field.name).cast(field.dataType).alias(name)
        for name, field in zip(names, layout.fields)
    ]).write.mode("append").format(file_format).save(path)

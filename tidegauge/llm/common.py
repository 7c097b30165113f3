"""Helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import scratch_folder

#: A word is a run of anything but blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows that travel to Python together where they carry whole texts.
TEXTS_PER_BATCH = 1000


def in_small_batches(frame: DataFrame) -> DataFrame:
    """Lower the session's Arrow batches to so many rows, from here on: a batch of texts is held
    several times, in Spark and in Python."""
    setting, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", frame.sparkSession.conf
    if not 0 < int(conf.get(setting)) <= TEXTS_PER_BATCH:
        conf.set(setting, str(TEXTS_PER_BATCH))
    return frame


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared checkpoint folder and read again.

    What is read later no longer depends on executors that may be lost meanwhile.
    """
    path = scratch_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def measured(frame: DataFrame) -> DataFrame:
    """The frame with ``n_chars`` brought up to date with its text, where it has that column."""
    if "n_chars" not in frame.columns:
        return frame
    kind = frame.schema["n_chars"].dataType
    return frame.withColumn("n_chars", F.length("text").cast(kind))


def free_name(frame: DataFrame, name: str) -> str:
    """The name, or a longer one where the frame has a column of it in any case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def seeded(seed: int, *columns: Column) -> Column:
    """A hash that orders rows as if at random, the same in each run."""
    return F.xxhash64(F.lit(seed), *columns)


def leading_bits(hashed: Column, bits: int) -> Column:
    """The leading bits of a hash as a number from 0, which grows with the unsigned hash."""
    return F.shiftrightunsigned(hashed, 64 - bits)

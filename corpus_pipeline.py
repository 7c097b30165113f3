"""A corpus pipeline of five stages over the documents table.

Language identification drops documents that are in no language it knows, line dedup removes
passages that repeat, the shingle join leaves one document of each group of near copies, mixing
brings the sources to their target weights, and packing cuts the mix into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import language_crf, line_dedup, mixing, packing, shingle_join
from tidegauge.llm.common import free_name, measured, stored, word_count

#: A document is rejected whose runs of three letters the language field knows to less than this
#: share of what it knows of an ordinary passage. That does not fall with the number of languages,
#: nor where a text switches between them.
LEAST_KNOWN = 0.8


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in languages that were learned; others, and texts without a letter, go.

    Null, empty and blank texts go. Rows of one text stay or go together; equal rows all stay. Where
    nothing can be learned, nothing stays. No documents give none.
    """
    told = free_name(docs, "language")
    found = language_crf.identify(docs, column=told).where(
        (F.col(f"{told}.lang_pred") != language_crf.UNDETERMINED)
        & (F.col(f"{told}.known") >= LEAST_KNOWN * F.col(f"{told}.usual"))
    )
    return found.drop(told)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of repeated passages; those of which nothing is left go.

    Null texts and texts that were empty before stay. Rows of one id and text are one document. No
    documents give none.
    """
    told = free_name(docs, "line_dedup")
    cleaned = line_dedup.dedup_lines(docs, column=told).where(
        f"text IS NULL OR text <> '' OR `{told}`.removed_windows = 0"
    )
    return measured(cleaned.drop(told))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies.

    Equal rows are near copies; rows without words have none and all stay. No documents give none.
    """
    return shingle_join.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as their source's target takes them, the last one cut.

    A null source is a source, the last. Rows without words are not taken. No documents give none.
    """
    mixed = mixing.mix(
        docs, [F.col("doc_id"), F.col("text")], F.array("source"), word_count(F.col("text"))
    )
    return measured(mixing.repeated(mixed))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mix, in sequences. A null text is empty; no documents give no pieces."""
    return packing.pack(docs, *packing.public_vocabulary())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: Training a field and tokenising are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each but the last keeps all columns, extra ones of any name too."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

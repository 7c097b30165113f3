"""Removal of passages that occur more than once, by windows of consecutive lines.

Every run of three lines is hashed. Of the windows that occur more than once in the whole corpus,
the first occurrence stays; the lines that later ones cover are removed, overlapping windows merged.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import in_small_batches


def _without(text: pd.Series, starts: pd.Series, width: pd.Series) -> pd.Series:
    """The texts without the lines that the windows beginning at ``starts`` cover."""

    def one(whole, begins, w):
        if whole is None or begins is None:
            return None
        lines, kept, at = whole.split("\n"), [], 0
        for begin in sorted(begins):
            if begin > at:
                kept.extend(lines[at:begin])
            at = max(at, begin + w)
        return "\n".join(kept + lines[at:])

    return pd.Series([one(*row) for row in zip(text, starts, width)], dtype=object)


def dedup_lines(docs: DataFrame, width: int = 3, column: str = "line_dedup") -> DataFrame:
    """Remove repeated windows of ``width`` lines from ``text``.

    Returns the rows with all their columns, the text cleaned, and ``column``, a struct of
    ``n_lines`` (before) and ``removed_windows`` (later occurrences, overlapping ones counted each).
    A column of that name is replaced.

    Lines end at line feeds and are compared as they are. A text of fewer lines is one window of
    all of them. Windows of blank lines only are left alone. Occurrences are ordered by doc_id
    (null first), a hash of the text, and position; rows with the same id and text count as one
    document and are cleaned alike. A null text has no lines and stays null; a text whose lines all
    go becomes empty. An empty table gives an empty result.
    """
    keyed = in_small_batches(docs).select(
        F.struct("*").alias("doc"), F.col("doc_id").alias("id"), F.col("text").alias("body"),
        F.xxhash64("text").alias("mark"),
    )
    windows = (
        keyed.where("body IS NOT NULL")
        .select("id", "mark", F.split("body", "\n", -1).alias("lines"))
        .select("id", "mark", F.expr(
            f"""inline_outer(filter(transform(
                sequence(0, greatest(size(lines) - {width}, 0)),
                i -> struct(i AS at, slice(lines, i + 1, {width}) AS span)),
                w -> exists(w.span, l -> trim(l) <> '')))"""
        ))
        .where("at IS NOT NULL")
        .select("id", "mark", "at", F.xxhash64("span").alias("h1"), F.hash("span").alias("h2"))
    )
    repeated = (
        windows.groupBy("h1", "h2")
        .agg(F.min(F.struct("id", "mark", "at")).alias("first"), F.count("*").alias("n"))
        .where("n > 1").drop("n")
    )
    later = (
        windows.join(repeated, ["h1", "h2"])
        .where(~F.struct("id", "mark", "at").eqNullSafe(F.col("first")))
        .groupBy("id", "mark").agg(F.collect_set("at").alias("starts"))
    )
    joined = keyed.alias("k").join(
        later.alias("l"),
        F.col("k.id").eqNullSafe(F.col("l.id")) & (F.col("k.mark") == F.col("l.mark")), "left",
    )
    without = F.pandas_udf(_without, "string")
    cleaned = joined.select(
        "doc", "starts",
        F.when(F.col("starts").isNull(), F.col("body")).alias("untouched"),
        without(F.when(F.col("starts").isNotNull(), F.col("body")), "starts", F.lit(width)).alias("cut"),
    )
    return cleaned.select(
        *[
            (F.coalesce("cut", "untouched") if c == "text" else F.col(f"doc.`{c}`")).alias(c)
            for c in docs.columns if c.lower() != column.lower()
        ],
        F.struct(
            F.coalesce(F.size(F.split("doc.text", "\n", -1)), F.lit(0)).alias("n_lines"),
            F.coalesce(F.size("starts"), F.lit(0)).alias("removed_windows"),
        ).alias(column),
    )

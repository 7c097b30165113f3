"""Benchmark decontamination: token windows of test items found in training texts.

The windows of the items are normalised, hashed and broadcast; every window of every text looks its
hash up, and a hit is verified word by word. The words that verified windows cover are the spans
that can be cut, or they condemn the document. Everything is a DataFrame expression.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import stored

#: What stands between words: ASCII that is neither a digit nor a letter. Beyond ASCII all is word.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
#: The same over text that is not yet in lower case.
_BETWEEN_RAW = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
#: Words of a window. An item of fewer words is one window.
WINDOW = 10
#: Bytes of windows and item ids that are broadcast at once. Larger benchmarks are looked up in
#: blocks of this size, each over all texts.
BROADCAST_BYTES = 32 << 20


def words(text: Column) -> Column:
    """The words of a text, A to Z in lower case; a null text has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.array_remove(F.split(lower, f"{BETWEEN}+", -1), "")


def _hashes(found: Column) -> Column:
    return F.transform(found, lambda w: F.xxhash64(w))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The distinct windows of ``benchmark`` (item_id, text): ``test_words``, ``hash``, ``items``.

    ``items`` are the ids, as strings, of the items that have the window. An id that is null is the
    empty string; rows of one id are one item. Items without a word have no window.
    """
    found = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        words(F.col("text")).alias("w"),
    ).where("size(w) > 0")
    runs = f"transform(sequence(0, greatest(size(w) - {window}, 0)), i -> slice(w, i + 1, {window}))"
    return (
        found.select("item", F.explode(F.expr(runs)).alias("test_words"))
        .groupBy("test_words").agg(F.array_sort(F.collect_set("item")).alias("items"))
        .select("test_words", F.xxhash64(_hashes(F.col("test_words"))).alias("hash"), "items")
    )


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """What of ``benchmark`` (item_id, text) occurs in ``docs`` (doc_id, text), a row per document.

    Returns doc_id, mark (a hash of the text), n_words, spans (begin and end of each run of hit
    words, in words from 0), n_hit and items (ids as sorted strings, each once).

    A document word is hit when it lies in any occurrence of a window of an item. A null or empty
    text, and one without words, has no words and no hits. Texts are scanned whole, of any length.
    Rows with the same id and text give equal rows, as many as there are; null ids are ids like any
    other. Other columns are not looked at. An empty benchmark hits nothing; no documents give no
    rows.
    """
    tests = stored(item_windows(benchmark, window), "test-windows")
    weight = F.expr(
        "48 + aggregate(test_words, 0L, (n, w) -> n + 16 + octet_length(w))"
        " + aggregate(items, 0L, (n, i) -> n + 16 + octet_length(i))"
    )
    # A row of figures; there are at most ``window`` lengths.
    known = tests.agg(
        F.sum(weight).alias("bytes"), F.array_sort(F.collect_set(F.size("test_words"))).alias("lengths")
    ).first()
    lengths, blocks = known.lengths or [window], max(1, -(-(known.bytes or 0) // broadcast_bytes))
    texts = docs.select("doc_id", "text", words(F.col("text")).alias("w")).select(
        "doc_id", F.xxhash64("text").alias("mark"), F.xxhash64(F.lit(13), "text").alias("mark2"),
        "w", F.size("w").alias("n"), _hashes(F.col("w")).alias("wh"),
    )
    # Place -1 stands for the document itself; it meets no window and is never filtered away.
    places = texts.select(
        "*", F.explode(F.sequence(F.lit(-1), F.greatest(F.col("n") - lengths[0], F.lit(-1)))).alias("at")
    )
    if len(lengths) > 1:
        places = places.select("*", F.explode(F.array(*map(F.lit, lengths))).alias("m"))
    else:
        places = places.withColumn("m", F.lit(lengths[0]))
    looked = places.where("at = -1 OR at + m <= n").withColumn(
        "hash", F.expr("CASE WHEN at >= 0 THEN xxhash64(slice(wh, greatest(at + 1, 1), m)) END")
    )

    def met(block: int) -> DataFrame:
        some = tests.where(F.pmod("hash", F.lit(blocks)) == block) if blocks > 1 else tests
        some = F.broadcast(some.withColumnRenamed("hash", "test_hash"))
        verified = F.expr("slice(w, greatest(at + 1, 1), m) = test_words")
        stands = (F.col("at") == -1) & (F.col("m") == lengths[0]) if block == 0 else F.lit(False)
        # Verified behind the join: as part of it, every place would build its words for the lookup.
        return looked.join(some, F.col("hash") == F.col("test_hash"), "left").where(stands | verified).select(
            "doc_id", "mark", "mark2", "n", "at", "m", "items"
        )

    hits = reduce(DataFrame.unionByName, map(met, range(blocks)))
    hit = F.when(F.col("at") >= 0, F.struct(F.col("at").alias("begin"), (F.col("at") + F.col("m")).alias("end")))
    gathered = hits.groupBy("doc_id", "mark", "mark2").agg(
        F.max("n").cast("long").alias("n_words"), F.array_sort(F.collect_set(hit)).alias("hits"),
        F.collect_set("items").alias("items"), F.count(F.when(F.col("at") == -1, 1)).cast("int").alias("copies"),
    )
    # Windows are at most ``window`` words long, so what one touches lies among as many before it.
    reach = f"transform(hits, (h, i) -> array_max(transform(slice(hits, greatest(i - {window}, 0) + 1," \
            f" least(i, {window}) + 1), g -> g.end)))"
    merged = gathered.withColumn("reach", F.expr(reach)).select(
        "doc_id", "mark", "mark2", "n_words", "copies",
        F.expr("filter(hits, (h, i) -> i = 0 OR get(reach, i - 1) < h.begin)").alias("opening"),
        F.expr("filter(reach, (r, i) -> i = size(hits) - 1 OR get(hits, i + 1).begin > r)").alias("ends"),
        F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
    )
    return merged.select(
        "doc_id", "mark", "mark2", "n_words",
        F.expr("transform(opening, (h, i) -> struct(h.begin AS begin, ends[i] AS end))").alias("spans"),
        "items", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"),
    ).select(
        "doc_id", "mark", "mark2", "n_words", "spans",
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.begin)").alias("n_hit"), "items",
    )


def _without(text: Column, spans: Column) -> Column:
    """The text without the words of ``spans`` and what stands before each of them."""
    parts = F.regexp_extract_all(text, F.lit(f"[{_BETWEEN_RAW}]*[^{_BETWEEN_RAW}]+"), F.lit(0))
    tail = F.regexp_extract(text, f"[{_BETWEEN_RAW}]*\\z", 0)
    # What stays lies between the spans: from 0 or a span's end to the next span or the last word.
    begins = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["begin"]), F.array(F.size(parts)))
    kept = F.transform(F.arrays_zip(begins.alias("b"), ends.alias("e")),
                       lambda k: F.slice(parts, k["b"] + 1, k["e"] - k["b"]))
    return F.concat(F.array_join(F.flatten(kept), ""), tail)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, whole: bool = False, window: int = WINDOW
) -> DataFrame:
    """``docs`` without what occurs in ``benchmark``, and ``decontamination`` about each row.

    By default the hit words go, with what stands before each, and all rows stay; with ``whole``
    the rows that have a hit go. ``decontamination`` is a struct of n_words, n_hit, spans and items
    as ``scan`` gives them; a column of that name is replaced. All other columns stay as they are,
    and texts without a hit too; null texts stay null.
    """
    names = [c for c in docs.columns if c != "decontamination"]
    told = scan(docs, benchmark, window).distinct().select(
        F.col("doc_id").alias("id"), "mark", "mark2",
        F.struct("n_words", "n_hit", "spans", "items").alias("told"),
    )
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"),
        F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(13), "text").alias("k2"),
    )
    joined = keyed.join(
        told, F.col("doc.doc_id").eqNullSafe(F.col("id")) & (F.col("k1") == F.col("mark"))
        & (F.col("k2") == F.col("mark2")), "left",
    )
    if whole:
        joined = joined.where("told.n_hit = 0")
    text = F.when(F.col("told.n_hit") > 0, _without(F.col("doc.text"), F.col("told.spans"))).otherwise(
        F.col("doc.text"))
    return joined.select(
        *[(text if c == "text" else F.col(f"doc.`{c}`")).alias(c) for c in names],
        F.col("told").alias("decontamination"),
    )

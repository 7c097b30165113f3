"""Licence scan by digests of normalised texts.

Whole documents, their paragraphs and their lines are normalised (case, punctuation, copyright
lines, equivalent spellings), and their digests looked up among those of known licence texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.license_texts import SPELLINGS, known_texts

#: Known licence texts come from a list in this package or a table of its kind; the join broadcasts
#: their digests only up to this many.
MOST_KNOWN = 100_000


#: Words after "copyright", or after "(c)", that go on with the prose of a licence, which may be
#: wrapped at any word: such a line is no copyright notice.
_AFTER_COPYRIGHT = (
    r"(?:[\"”.]|-[\p{L}-]|[ \t,]+(?:"
    r"(?:holders?|owners?|notices?|statements?)(?![\p{L}\p{N}])(?![ \t]*:)"
    r"|(?:laws?|interests?|disclaimers?|permissions?|licen[cs]es?|treaty|treaties|ownership|doctrines|line|patents?|"
    r"resulting|including|and|or|on|if|is|are|of this|the (?:software|library|program))(?![\p{L}\p{N}])))"
)
_AFTER_SIGN = r"[ \t]+(?:you|under|representations|the licen[cs]es)(?![\p{L}\p{N}])"
#: A line that begins as a copyright notice, after comment marks or other punctuation.
_COPYRIGHT_LINE = (
    r"(^|\n)[^\p{L}\p{N}\n]*?(?:copyright(?![\p{L}\p{N}])(?!" + _AFTER_COPYRIGHT + r")"
    r"|\([ \t]*c[ \t]*\)(?!" + _AFTER_SIGN + r")|©"
    r"|all[^\p{L}\p{N}\n]+rights[^\p{L}\p{N}\n]+reserved(?![\p{L}\p{N}]))[^\n]*"
)


def bare_words(text: Column) -> Column:
    """Lower case; lines that begin as copyright notices emptied, also behind comment marks; all but
    letters, digits and line feeds one blank."""
    kept = F.regexp_replace(F.lower(text), _COPYRIGHT_LINE, "$1")
    return F.regexp_replace(kept, r"[^\p{L}\p{N}\n]+", " ")


def respelled(words: Column) -> Column:
    """Bare words in their common spellings. Most texts hold none of the others: these are looked
    for together before they are replaced one by one."""
    # Two blanks between words, so that neighbours do not share the blank they are found by.
    apart = F.replace(F.replace(words, F.lit("\n"), F.lit(" \n ")), F.lit(" "), F.lit("  "))
    apart = F.concat(F.lit(" "), apart, F.lit(" "))
    for spelled, common in SPELLINGS:
        apart = F.replace(apart, F.lit(f" {spelled} "), F.lit(f" {common} "))
    other = "|".join(spelled for spelled, _ in SPELLINGS)
    return F.when(
        words.rlike(rf"(?:^|[ \n])(?:{other})(?:[ \n]|$)"), F.replace(apart, F.lit("  "), F.lit(" "))
    ).otherwise(words)


def normal_lines(texts: DataFrame, *others: str | Column) -> DataFrame:
    """``lines``, the normalised lines of ``text``, beside other columns."""
    words = texts.select(*others, bare_words(F.col("text")).alias("words"))
    kept = [c for c in words.columns if c != "words"]
    return words.select(*kept, respelled(F.col("words")).alias("normal")).select(
        *kept, F.transform(F.split("normal", "\n"), lambda l: F.trim(l)).alias("lines")
    )


def _joined(lines: str) -> str:
    return f"array_join(filter({lines}, l -> l <> ''), ' ')"


def known_digests(known: DataFrame) -> DataFrame:
    """Digest and licence of known texts; of two licences with one digest the first by name."""
    return (
        normal_lines(known, "license_id").select("license_id", F.expr(_joined("lines")).alias("normal"))
        .where("normal <> ''")
        .groupBy(F.md5("normal").alias("digest")).agg(F.min("license_id").alias("license_id"))
    )


def published(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known_texts(), "license_id string, text string")


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Licences of every document.

    Returns ``doc_id``, ``text_digest`` (of the whole normalised text), ``text_license`` (the licence
    that the whole text is, or null), ``notices`` (paragraphs and lines that are a known text) and
    ``notice_licenses`` (their licences, distinct, ordered, joined by commas, or null). A paragraph
    is a run of lines between blank ones; of one line it counts as a line.

    A null text counts as empty; a text of which nothing is left has the digest of the empty text
    and no licence. Rows with the same id and text give equal rows. Other columns are not looked at.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    digests = known_digests(published(spark) if known is None else known)
    if known is None or known.limit(MOST_KNOWN + 1).count() <= MOST_KNOWN:
        digests = F.broadcast(digests)
    lines = normal_lines(
        docs.select("doc_id", F.xxhash64("text").alias("mark"), F.coalesce("text", F.lit("")).alias("text")),
        "doc_id", "mark", F.expr("transform(split(text, '\n'), l -> trim(l))").alias("raw"),
    )
    units = lines.select(
        "doc_id", "mark",
        F.expr(f"""concat(
            array(struct('text' AS kind, {_joined('lines')} AS normal)),
            transform(filter(lines, l -> l <> ''), l -> struct('line' AS kind, l AS normal)),
            transform(
                filter(split(array_join(transform(lines, (l, i) ->
                    if(get(raw, i) = '', '\f', l)), '\n'), '\f'),
                    p -> instr(trim(BOTH '\n' FROM p), '\n') > 0),
                p -> struct('paragraph' AS kind, {_joined("split(p, '\n')")} AS normal)))""").alias("units"),
    # Never empty. An inner explode would be preceded by a filter that computes all of it once more.
    ).select("doc_id", "mark", F.explode_outer("units").alias("unit"))
    looked = units.select(
        "doc_id", "mark", "unit.kind", F.md5("unit.normal").alias("digest")
    ).join(digests, "digest", "left")
    is_text = F.col("kind") == "text"
    found = looked.groupBy("doc_id", "mark").agg(
        F.count(F.when(is_text, 1)).alias("copies"),
        F.max(F.when(is_text, F.col("digest"))).alias("text_digest"),
        F.max(F.when(is_text, F.col("license_id"))).alias("text_license"),
        F.count(F.when(~is_text, F.col("license_id"))).alias("hits"),
        F.collect_set(F.when(~is_text, F.col("license_id"))).alias("licenses"),
    )
    return found.select(
        "doc_id", "text_digest", "text_license",
        F.expr("hits div copies").alias("notices"),
        F.expr("nullif(array_join(array_sort(licenses), ','), '')").alias("notice_licenses"),
        F.explode(F.expr("array_repeat(0, cast(copies AS int))")).alias("copy"),
    ).drop("copy")

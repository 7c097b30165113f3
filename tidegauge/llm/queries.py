"""The registered queries of the corpus operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import (
    conversation_repair,
    decontaminate,
    exact_topk,
    hash_forest,
    hilbert_shards,
    language_crf,
    license_scan,
    license_sql,
    line_dedup,
    mixing,
    packing,
    shingle_join,
    warc,
    whitening,
)
from tidegauge.llm.common import table, text_bytes, word_count
from tidegauge.session import scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op6_hilbert_shards")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", "source", "lang", "text",
    ).select(
        "doc_id", "source", "lang",
        (text_bytes(F.col("text")) + 16).alias("size"),
        F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))).alias("text_crc32"),
    )
    dimensions = [F.col("source"), F.col("lang"), F.col("size"), F.col("doc_id")]
    placed = hilbert_shards.shard(docs, dimensions, [F.col("doc_id"), F.col("text_crc32")])
    return placed.select(
        "doc.doc_id", "doc.size", "doc.text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve_index",
    )


@query("op8_source_mix")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("mark")
    )
    mixed = mixing.mix(docs, [F.col("doc_id"), F.col("mark")], F.array("source"), F.col("size"))
    return mixed.select(
        "doc.doc_id", "size", F.expr("shares[0].source_size").alias("source_size"),
        F.expr("shares[0].target").alias("target"), "taken",
    )


@query("op1_license_scan", sql=license_sql.checking_sql())
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"))


@query("op2_pack_sequences")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), *packing.public_vocabulary())


@query("op4_line_dedup", sql="""
    WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
    windows AS (
        SELECT doc_id, pos, list_slice(lines, pos, pos + 2) AS span
        FROM (SELECT doc_id, lines, unnest(range(1, greatest(len(lines) - 2, 1) + 1)) AS pos FROM split)),
    later AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY span ORDER BY doc_id, pos) AS n FROM windows
            WHERE len(list_filter(span, lambda l: trim(l) <> '')) > 0)
        WHERE n > 1),
    covered AS (
        SELECT doc_id, list(DISTINCT p) AS places, count(DISTINCT pos) AS n
        FROM (SELECT doc_id, pos, unnest(range(pos, pos + 3)) AS p FROM later) GROUP BY doc_id)
    SELECT s.doc_id,
           CASE WHEN c.doc_id IS NULL THEN s.text ELSE coalesce(array_to_string(list_filter(
               lines, lambda l, i: NOT list_contains(places, i)), chr(10)), '') END AS text,
           CAST(coalesce(len(lines), 0) AS INTEGER) AS n_lines,
           CAST(coalesce(c.n, 0) AS INTEGER) AS removed_windows
    FROM split s LEFT JOIN covered c ON c.doc_id = s.doc_id
""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "text", "line_dedup.*")


_HEX_BITS = (
    "array_to_string(list_transform(range(1, 41), lambda i: "
    "lpad(to_binary(strpos('0123456789abcdef', substr(hex, i, 1)) - 1), 4, '0')), '')"
)
_BASE32 = (
    "array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + "
    + " + ".join(f"{16 >> k} * CAST(substr(bits, CAST(5 * i + {k + 1} AS INT), 1) AS INT)" for k in range(5))
    + ", 1)), '')"
)


@query("op7_warc_pages", sql=f"""
    SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
           CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id < last THEN last END AS refers_to
    FROM (SELECT *, {_HEX_BITS} AS bits FROM (
        SELECT page_id, sha1(coalesce(html, '')) AS hex,
               CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
               max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
        FROM pages))
""")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch_folder(spark, "warc")
    warc.write_pages(table(spark, folder, "pages"), archives)
    return warc.page_records(warc.read_split(spark, archives))


@query("op3_exact_topk", sql="""
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
    WHERE rank <= 10
""")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return exact_topk.top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op9_hash_forest")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return hash_forest.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op5_language_crf")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return language_crf.identify(docs).select(
        "doc_id", language_crf.held_out(F.col("doc_id")).alias("held_out"),
        "language.lang_pred", "language.score",
    )


@query("op10_shingle_join", sql=r"""
    WITH RECURSIVE split AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
            ELSE list_distinct(list_transform(range(1, len(words) - 3),
                lambda i: array_to_string(list_slice(words, i, i + 4), ' '))) END AS shingles FROM split),
    sizes AS (SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n FROM sets),
    entries AS (SELECT doc_id, unnest(shingles) AS shingle FROM sets),
    common AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
        FROM entries x JOIN entries y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
    links AS (
        SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
    reached(doc_id, root) AS (
        SELECT doc_id, doc_id FROM sets
        UNION SELECT links.b, root FROM reached JOIN links ON links.a = reached.doc_id)
    SELECT doc_id, n AS n_shingles, component_id
    FROM sizes JOIN (SELECT doc_id, min(root) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
""")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return shingle_join.join(table(spark, folder, "documents")).drop("mark")


@query("op11_spectrum_whitening")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    rows, model = whitening.whiten(table(spark, folder, "embeddings"))
    return rows.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened",
        F.get(F.array(*map(F.lit, model.explained)).cast("array<double>"), F.col("place")).alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )


@query("op12_conversation_repair")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, folder, "conversations"))
    return conversation_repair.repair(rows, F.col("gone"), F.col("copy"))


@query("op13_decontamination", sql=r"""
    WITH docs AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    items AS (
        SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark),
    tests AS (
        SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(list_slice(w, pos, pos + 9), ' ') AS span
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS pos FROM items WHERE len(w) > 0)),
    places AS (
        SELECT doc_id, pos, m, array_to_string(list_slice(w, pos, pos + m - 1), ' ') AS span
        FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM docs), (SELECT DISTINCT m FROM tests)
        WHERE pos + m - 1 <= len(w)),
    hits AS (
        SELECT doc_id, pos, m, item FROM places JOIN tests USING (m, span)),
    told AS (
        SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS names
        FROM hits GROUP BY doc_id),
    covered AS (
        SELECT doc_id, count(DISTINCT p) AS n
        FROM (SELECT doc_id, unnest(range(pos, pos + m)) AS p FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(t.n, 0) AS BIGINT) AS n_items, sha256(coalesce(t.names, '')) AS items_sha256,
           coalesce(c.n, 0) > 0 AS contaminated
    FROM docs d LEFT JOIN told t ON t.doc_id = d.doc_id LEFT JOIN covered c ON c.doc_id = d.doc_id
""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.scan(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )

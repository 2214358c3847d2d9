"""The queries of this subpackage and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.llm import ann, bpe, conversation_sql, exact, licenses, lines, maintext, packing, quality, repair, simhash, suffix, trie, warc
from grantlens.llm.common import table
from grantlens.session import stage, staged_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


@query("op1_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Encode and decode every text; no SQL says this, tests compare with the rank file's library."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, folder, "documents"), path, pattern)
    return bpe.decode(encoded, path, pattern).select(
        "doc_id",
        F.expr("cast(length(ids) / 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op3_exact_dedup",
    r"""
    WITH norm AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
    sized AS (SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
              row_number() OVER (PARTITION BY t ORDER BY doc_id) AS nth, t FROM norm WINDOW g AS (PARTITION BY t))
    SELECT doc_id, keep_id, group_size, nth = 1 AS kept, sha256(t) AS text_sha256 FROM sized
    """,
)
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return exact.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op9_simhash")
def simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of fingerprints; DuckDB has no XXH64, tests compare with brute force."""
    return simhash.near_groups(table(spark, folder, "documents"))


@query("op10_suffix_dedup")
def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes that stay once repeated strings are removed; tests compare with brute force."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def digest_pieces(docs: DataFrame) -> DataFrame:
    """Pieces of ``docs`` with the CRC of their ids, written to the shared folder."""
    pieces = packing.token_pieces(
        docs,
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        {"<|endoftext|>": 50256},
    )
    slim = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return stage(slim, "pieces")


@query("op7_packing")
def pack_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Token pieces and their places; tests check ids, gaps and room of every sequence."""
    return packing.pack(digest_pieces(table(spark, folder, "documents")))


@query("op8_quality")
def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores by a classifier fitted on the other folds; tests measure held-out accuracy."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.score(docs, model).select("doc_id", "held_out", "score", "predicted")


@query(
    "op5_warc",
    """
    WITH sized AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
    seen AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS d FROM sized),
    first AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS f FROM seen)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
           CASE WHEN n >= 100 AND f <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 100 AND f <> page_id THEN f END AS refers_to
    FROM first
    """,
)
def warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    archive = staged_folder(spark, "warc")
    manifest = warc.write_archive(table(spark, folder, "pages"), archive)
    return warc.read_archive(manifest, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_nearest")
def nearest(spark: SparkSession, folder: str) -> DataFrame:
    """Approximate neighbours of every hundredth vector; tests measure recall against brute force."""
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op2_license_scan", licenses.check_sql(licenses.NOTICES))
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query("op4_line_dedup")
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines to drop per document; classes are transitive, so tests compare with brute force."""
    return lines.dedup_lines(table(spark, folder, "documents"))


@query("op11_conversation_repair", conversation_sql.REPAIR)
def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.audit(table(spark, folder, "conversations"))


@query(
    "op12_main_text",
    # what the field should find is plain here: all pages of the test tables have an article element
    r"""
    WITH articles AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS a FROM pages),
    parts AS (SELECT page_id, url, unnest(regexp_split_to_array(a, '</?(?:p|h1)>')) AS part, generate_subscripts(regexp_split_to_array(a, '</?(?:p|h1)>'), 1) AS nth FROM articles),
    plain AS (SELECT *, regexp_replace(replace(part, '<br>', ' '), '<[^>]+>', '', 'g') AS marked FROM parts),
    blocks AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(marked, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS block FROM plain)
    SELECT page_id, url, coalesce(string_agg(block, chr(10) || chr(10) ORDER BY nth) FILTER (block <> ''), '') AS text,
      length(coalesce(string_agg(block, chr(10) || chr(10) ORDER BY nth) FILTER (block <> ''), ''))::BIGINT AS n_chars
    FROM blocks GROUP BY page_id, url
    """,
)
def main_text(spark: SparkSession, folder: str) -> DataFrame:
    return maintext.extract(table(spark, folder, "pages").select("page_id", "url", "html"))


@query("op13_conversation_trie", conversation_sql.TRIE)
def conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.conversation_trie(table(spark, folder, "conversations"))

"""The registered query of each operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, exact_dedup, mixing, negatives, pieces, quality, secrets_scan, simhash, token_counts, toxicity, vafile, warc
from .common import read


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(read(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.scan_secrets(read(spark, sf_dir, "documents"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(read(spark, sf_dir, "embeddings"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(read(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read(spark, sf_dir, "pages"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.round_trip(rows.unionByName(chat.planted(spark, rows)))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_dedup, op2_token_counts, op3_secret_scan, op4_top_k, op5_mix_sources, op6_toxicity, op7_sentencepiece,
    op8_warc, op9_quality, op10_exact_dedup, op11_chat_format, op12_hard_negatives,
    op13_token_alignment)}

SQL = {
    "op10_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op4_top_k": """
        WITH v AS (
            SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS vec
            FROM embeddings
            WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scores AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vec, c.vec)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec))
        SELECT query_id, rank::INT AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
        WHERE rank <= 5""",
    "op12_hard_negatives": """
        WITH v AS (
            SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * x::DOUBLE) FOR x IN embedding] AS vec
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scores AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same, list_inner_product(a.vec, c.vec)::BIGINT AS score
            FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.vec) = len(c.vec)),
        positives AS (
            SELECT * FROM (
                SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
                       row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth
                FROM scores WHERE same)
            WHERE nth <= 5),
        negatives AS (
            SELECT anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
                   row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
            FROM positives JOIN scores s USING (anchor_id)
            WHERE NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
        SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score
        FROM negatives WHERE rank <= 3""",
    # the default template writes 18 characters around a user's text, 8 around an assistant's, 15 around a system's and
    # 19 and the role around another's; a text gets a backslash more for each backslash and each control string, and at
    # an end that could make one with its neighbours (roles are taken to need none)
    "op11_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, n, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)),
        controls AS (
            SELECT ['<s>', '</s>', '[INST]', '[/INST]', '<<SYS>>', '<</SYS>>', '[ROLE]', '[TEXT]', '[/TEXT]'] AS c),
        marked AS (
            SELECT *, length(text) + (length(text) - length(replace(text, '', '')))
                + list_sum([(length(text) - length(replace(text, x, ''))) // length(x) FOR x IN c])
                + (text <> '' AND (len([x FOR x IN c IF contains(x, text)]) > 0
                    OR len([x FOR x IN c IF len([n FOR n IN range(1, length(x)) IF starts_with(text, substr(x, n + 1))]) > 0]) > 0))::INT
                + (len([x FOR x IN c IF len([n FOR n IN range(1, length(x)) IF ends_with(text, substr(x, 1, n))]) > 0]) > 0)::INT
                AS escaped
            FROM turns, controls)
        SELECT conv_id,
               count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(escaped + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 8 WHEN 'system' THEN 15
                                       ELSE 19 + length(role) END)::BIGINT AS formatted_chars
        FROM marked GROUP BY conv_id""",
    # base32 of the 160 bits: 5-bit groups cut from pairs of hexadecimal digits
    "op8_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
        tops AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS top FROM payloads)
        SELECT page_id,
               strlen(payload) AS payload_bytes,
               list_aggregate([
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((
                       (instr('0123456789abcdef', substr(hex, 5 * i // 4 + 1, 1)) - 1) * 16
                       + instr('0123456789abcdef', substr(hex, 5 * i // 4 + 2, 1)) - 1)
                       >> (3 - 5 * i % 4)) & 31)::INT, 1)
                   FOR i IN range(32)], 'string_agg', '') AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> top THEN top END AS refers_to
        FROM tops""",
}

"""The registered queries of the operators here, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, encoding, language_model, lexical, neardup, packing, quality, simhash, substrings, token_counts, topk, toxicity, warc
from .common import ship_package

VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.language_scores(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), whole=True)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair_report(rows, conversations.damaged(rows))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_token_counts,
        op3_exact_top_k,
        op4_simhash_near_dedup,
        op5_substring_dedup,
        op6_language_model,
        op7_toxicity,
        op8_bpe_encoding,
        op9_embedding_near_dedup,
        op10_quality_classifier,
        op11_warc,
        op12_ranked_search,
        op13_conversation_repair,
    )
}

ORACLE = {
    "op3_exact_top_k": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) = len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)])
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
                   CAST(list_sum([a.q[i] * b.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
        ) SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op5_substring_dedup": r"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
        ), g AS (
            SELECT doc_id, i, list_slice(words, i, i + 12) AS gram
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)
        ), f AS (
            SELECT doc_id, i, min(doc_id) OVER (PARTITION BY gram) AS first FROM g
        ), gone AS (
            SELECT DISTINCT doc_id, i + k AS i FROM f, range(0, 13) t(k) WHERE first < doc_id
        ), one AS (
            SELECT w.doc_id, p.i, w.words[p.i] AS word
            FROM w, LATERAL (SELECT unnest(range(1, len(w.words) + 1)) AS i) p
        ), kept AS (
            SELECT one.doc_id, count(*) AS n_words, count(gone.i) AS n_removed,
                   coalesce(string_agg(word, ' ' ORDER BY one.i) FILTER (gone.i IS NULL), '') AS kept
            FROM one LEFT JOIN gone USING (doc_id, i) GROUP BY one.doc_id
        ) SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
                 sha256(coalesce(kept, '')) AS kept_sha256
          FROM w LEFT JOIN kept USING (doc_id)""",
    "op9_embedding_near_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL
              AND len(embedding) = len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)])
              AND len([x FOR x IN embedding IF x <> 0]) > 0
        ), u AS (
            SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
               AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98
        ), reach AS (
            SELECT a AS vec_id, least(a, b) AS low FROM links
            UNION
            SELECT links.a, reach.low FROM reach JOIN links ON links.b = reach.vec_id
        ), ends AS (
            SELECT vec_id, min(low) AS low FROM reach GROUP BY vec_id
        ), n AS (
            SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
        ) SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(ends.low, e.vec_id) AS component_id,
                 coalesce(ends.low, e.vec_id) = e.vec_id AS kept
          FROM embeddings e LEFT JOIN n USING (vec_id) LEFT JOIN ends USING (vec_id)""",
    "op11_warc": """
        WITH p AS (
            SELECT row_number() OVER () AS row, page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages
        ), g AS (
            SELECT *, CASE WHEN size >= 1000
                THEN first_value(row) OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, row DESC) ELSE row END AS best,
                first_value(page_id) OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, row DESC) AS best_page
            FROM p
        ) SELECT page_id, size AS payload_bytes, sha1(html) AS payload_digest,
                 CASE WHEN best = row THEN 'response' ELSE 'revisit' END AS record_type,
                 CASE WHEN best <> row THEN best_page END AS refers_to FROM g""",
    "op12_ranked_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, terms FROM (
                SELECT doc_id, regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents)
            WHERE len(terms) > 0
        ), corpus AS (
            SELECT count(*) AS n, CAST(sum(len(terms)) AS BIGINT) AS total FROM d
        ), asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
        ), counts AS (
            SELECT row, doc_id, size, term, count(*) AS tf
            FROM (SELECT row, doc_id, len(terms) AS size, unnest(terms) AS term FROM d)
            WHERE term IN (SELECT term FROM asked) GROUP BY ALL
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, corpus GROUP BY term, n
        ), scores AS (
            SELECT item_id, row, doc_id,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * n) // total)))) AS BIGINT) AS score
            FROM asked JOIN counts USING (term) JOIN weights USING (term), corpus GROUP BY item_id, row, doc_id
        ), best AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, row) AS INTEGER) AS rank,
                   doc_id, score FROM scores WHERE score > 0
        ) SELECT item_id, rank, doc_id, score FROM best WHERE rank <= 10""",
    "op13_conversation_repair": r"""
        WITH RECURSIVE draws AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   xor(list_reduce(
                       list_concat([4294967295::BIGINT], [ascii(c)::BIGINT FOR c IN string_split(
                           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')]),
                       lambda crc, byte: list_reduce(
                           [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                           lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)),
                       4294967295::BIGINT) % 20 AS draw
            FROM conversations
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
                   CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN draw = 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM draws WHERE draw <> 0
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS time
            FROM damaged
        ), faults AS (
            SELECT conv_id, turn, role, text, i, left(role, 1) AS initial,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS initial_before,
                   CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN time > 1 THEN 2
                        WHEN right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?')
                        THEN 3 ELSE 0 END AS fault
            FROM numbered
        ), facts AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
                   count(*) FILTER (fault = 3) AS truncated,
                   count(*) FILTER (initial_before IS NOT NULL AND initial_before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faults GROUP BY conv_id
        ), inserts(before, inserted, place, said) AS (
            VALUES (0, 0, 0, ''), (1, 0, 1, ''), (2, 0, 2, ''), (3, 0, 3, ''),
                   (0, 1, 2, 'user:'), (1, 1, 2, e'\nuser:'), (2, 1, 3, e'\nassistant:'), (3, 1, 2, e'\nuser:'),
                   (0, 2, 3, e'user:\nassistant:'), (1, 2, 3, e'\nuser:\nassistant:'),
                   (2, 2, 2, e'\nassistant:\nuser:'), (3, 2, 3, e'\nuser:\nassistant:')
        ), edits(letter, initial, place, after, price) AS (
            VALUES ('D', NULL, 0, 0, 4), ('D', NULL, 1, 1, 4), ('D', NULL, 2, 2, 4), ('D', NULL, 3, 3, 4),
                   ('R', NULL, 0, 2, 3), ('R', NULL, 1, 2, 3), ('R', NULL, 2, 3, 3), ('R', NULL, 3, 2, 3),
                   ('K', 's', 0, 1, 0), ('K', 'u', 0, 2, 0), ('K', 'u', 1, 2, 0), ('K', 'u', 3, 2, 0), ('K', 'a', 2, 3, 0)
        ), paths AS (
            SELECT conv_id, 0::BIGINT AS i, 0 AS place, 0::BIGINT AS cost, '' AS audit, '' AS said FROM facts
            UNION ALL
            SELECT conv_id, i, after, cost, audit, said FROM (
                SELECT p.conv_id, f.i, e.after,
                       p.cost + 3 * n.inserted + e.price + CASE WHEN f.fault = 3 AND e.letter <> 'D' THEN 3 ELSE 0 END AS cost,
                       p.audit || repeat('I', n.inserted) || e.letter AS audit,
                       p.said || n.said || CASE WHEN e.letter = 'D' THEN '' ELSE
                           CASE WHEN e.place = 0 THEN '' ELSE chr(10) END
                           || CASE WHEN e.letter = 'K' THEN f.role WHEN e.after = 2 THEN 'user' ELSE 'assistant' END
                           || ':' || f.text END AS said,
                       row_number() OVER (PARTITION BY p.conv_id, e.after ORDER BY
                           p.cost + 3 * n.inserted + e.price + CASE WHEN f.fault = 3 AND e.letter <> 'D' THEN 3 ELSE 0 END,
                           p.audit || repeat('I', n.inserted) || e.letter) AS best
                FROM paths p JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
                JOIN inserts n ON n.before = p.place
                JOIN edits e ON e.place = n.place AND (e.letter = 'D' OR f.fault NOT IN (1, 2))
                            AND (e.initial IS NULL OR e.initial = f.initial)
            ) WHERE best = 1
        ), ends AS (
            SELECT p.conv_id, p.cost + 3 * n.inserted AS cost, p.audit || repeat('I', n.inserted) AS audit, p.said || n.said AS said
            FROM paths p JOIN facts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i
            JOIN inserts n ON n.before = p.place AND n.place IN (0, 3)
            QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + 3 * n.inserted, p.audit || repeat('I', n.inserted)) = 1
        ) SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
                 coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
                 coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
          FROM (SELECT DISTINCT conv_id FROM conversations) o
          LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM o.conv_id
          LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM o.conv_id""",
}

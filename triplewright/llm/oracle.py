"""DuckDB SQL for the queries that SQL can express over whole tables.

The others (near-duplicate components, tokenizers, Pareto ranks, hashes of slots, trained
models, graph search, ordered rules) are compared with brute force in ``tests/llm``.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE: dict[str, str] = {
    "op1_warc_index": """
        WITH hashed AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), first AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id
            FROM hashed
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id > first_id THEN first_id END AS refers_to
        FROM first
    """,
    "op10_quality_ledger": rf"""
        WITH words AS (
            SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
        ), windows AS (
            SELECT doc_id, i, words[i:i + 7] AS window_words
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM words)
        ), repeated AS (
            SELECT doc_id, i FROM windows
            QUALIFY count(*) OVER (PARTITION BY doc_id, window_words) > 1
        ), covered AS (
            SELECT doc_id, count(DISTINCT place) AS n_repeat_words
            FROM (SELECT doc_id, unnest(range(i, i + 8)) AS place FROM repeated) GROUP BY doc_id
        ), lines AS (
            SELECT doc_id, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
            FROM words
        ), measured AS (
            SELECT w.doc_id, len(words) AS n_words,
                   CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                   length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                   length(text) - length(replace(text, '!', '')) AS n_exclamations,
                   length(text) - length(regexp_replace(text, '\p{{L}}', '', 'g')) AS n_letters,
                   len(l.lines) AS n_lines,
                   len(l.lines) - len(list_distinct(l.lines)) AS n_dup_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words
            FROM words w JOIN lines l USING (doc_id) LEFT JOIN covered USING (doc_id)
        ), judged AS (
            SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
                   CASE WHEN n_words < 20 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
                   + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
                   + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
                   + CASE WHEN word_chars > 20 * n_words THEN 16 ELSE 0 END
                   + CASE WHEN 2 * n_dup_lines > n_lines THEN 32 ELSE 0 END
                   + CASE WHEN 10 * n_letters < 4 * word_chars THEN 64 ELSE 0 END
                   + CASE WHEN 5 * n_exclamations > n_words THEN 128 ELSE 0 END
                   + CASE WHEN n_words > 1000000 THEN 256 ELSE 0 END AS failed_bits
            FROM measured
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               failed_bits & 255 = 0 AS kept, CAST(failed_bits AS BIGINT) AS failed_bits
        FROM judged
    """,
    "op11_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, row_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place
            FROM (SELECT doc_id, row_number() OVER () AS row_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
        ), keyed AS (
            SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), repeated AS (
            SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT row_id) >= 3
        ), judged AS (
            SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.holder AS dropped FROM keyed k LEFT JOIN repeated r USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
        FROM judged GROUP BY row_id, doc_id
    """,
}
